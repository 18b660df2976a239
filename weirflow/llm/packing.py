"""Packing by minimum bin slack.

Documents longer than a window give full windows and a rest. Rests are packed some millions of ids at a time:
a window starts with the longest rest, and a bitset holds which sums of the lengths still there can be reached
(bit s: a choice with sum s exists). The sum closest to the free room is taken, and the bitsets kept per step
tell how many pieces of each length make it up. Rests of windows that could not be filled wait for the next
round; the last of a task are laid end to end and cut, first into full windows, then into powers of two, so
that nothing needs padding.

Each task packs the rows it reads, nothing is shuffled and no id is lost. Null and empty texts are one end id.
Repeated rows are packed each; a null id stays null. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from weirflow.llm.tokens import blocks, encoder

ROUND_IDS = 4 << 20


def fullest(lengths: list[int], count: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to ``room`` as it can be, without going over."""
    reach, steps, mask, goal = 1, [], (1 << (room + 1)) - 1, 1 << room
    for n in reversed(lengths[: bisect_right(lengths, room)]):
        for _ in range(min(count[n], room // n)):
            more = (reach | (reach << n)) & mask
            if more == reach:
                break
            steps.append((n, reach))
            reach = more
        if reach & goal:
            break
    total, taken = reach.bit_length() - 1, {}
    for n, before in reversed(steps):
        if not (before >> total) & 1:
            taken[n] = taken.get(n, 0) + 1
            total -= n
    return taken


def fill(sizes: list[int], room: int) -> tuple[list[list[int]], list[int]]:
    """Groups of places in ``sizes`` whose sizes add up to ``room``, and the places left over."""
    places: dict[int, list[int]] = {}
    for i, n in enumerate(sizes):
        places.setdefault(n, []).append(i)
    count, lengths = {n: len(p) for n, p in places.items()}, sorted(places)
    full, left = [], []

    def take(n: int, k: int) -> list[int]:
        got = [places[n].pop() for _ in range(k)]
        count[n] -= k
        if not count[n]:
            del lengths[bisect_right(lengths, n) - 1]
        return got

    while lengths:
        longest = lengths[-1]
        group = take(longest, 1)
        for n, k in fullest(lengths, count, room - longest).items():
            group += take(n, k)
        (full.append(group) if sum(sizes[i] for i in group) == room else left.extend(group))
    return full, left


class _Writer:
    """Rows of pieces, handed out in batches of some megabytes."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.size = schema, [], 0
        self.next = TaskContext.get().partitionId() << 32

    def sequence(self, pieces: list[tuple]) -> None:
        """pieces: (id, first, ids, number of ids in the document)"""
        offset, total = 0, sum(len(p[2]) for p in pieces)
        for doc, first, ids, n in pieces:
            self.rows.append((doc, first, len(ids), ids.astype("<u4").tobytes(), n, self.next, offset, total))
            self.size += 4 * len(ids)
            offset += len(ids)
        self.next += 1

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            columns = list(zip(*self.rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
            self.rows, self.size = [], 0


def _cut(pieces: list[tuple], room: int) -> Iterator[list[tuple]]:
    """The pieces end to end, cut into sequences of ``room`` and then of the powers of two that add up to the rest."""
    total = sum(len(p[2]) for p in pieces)
    rest = total % room
    sizes = [room] * (total // room) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    at, used = 0, 0
    for size in sizes:
        out = []
        while size:
            doc, first, ids, n = pieces[at]
            part = ids[used : used + size]
            out.append((doc, first + used, part, n))
            size -= len(part)
            used += len(part)
            if used == len(ids):
                at, used = at + 1, 0
        yield out


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", room: int = 4096, end: int = 2) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, sequence_tokens."""
    kind = docs.schema[doc_id].dataType.simpleString()
    out = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, waiting, held = encoder(tokenizer), [], 0
        writer = None
        for batch in blocks(batches, "text"):
            if writer is None:
                writer = _Writer(pa.schema([("id", batch.schema.field("id").type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())] + [(c, pa.int64()) for c in ("doc_tokens", "sequence_id", "offset", "sequence_tokens")]))
            for doc, ids in zip(batch.column("id").to_pylist(), coder.encode(batch.column("text"), end)):
                n = len(ids)
                whole = n - n % room
                for at in range(0, whole, room):
                    writer.sequence([(doc, at, ids[at : at + room], n)])
                if whole < n:
                    waiting.append((doc, whole, ids[whole:], n))
                    held += n - whole
            if held >= ROUND_IDS:
                full, left = fill([len(p[2]) for p in waiting], room)
                for group in full:
                    writer.sequence([waiting[i] for i in group])
                waiting = [waiting[i] for i in left]
                held = sum(len(p[2]) for p in waiting)
            yield from writer.batches(8 << 20)
        if writer is not None:
            full, left = fill([len(p[2]) for p in waiting], room)
            for group in full:
                writer.sequence([waiting[i] for i in group])
            for group in _cut([waiting[i] for i in left], room):
                writer.sequence(group)
            yield from writer.batches(0)

    if room < 1:
        raise ValueError("a sequence needs room for one id")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, out).withColumnRenamed("id", doc_id)

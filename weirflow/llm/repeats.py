"""Removal of long repeats with a logarithmic family of suffix arrays.

A byte goes if it lies in a string of ``WINDOW`` bytes that also starts anywhere else. Suffixes are indexed sparsely: the
anchor of a window is the smallest of its ``HEAD``-byte substrings by fingerprint (the last of equals), so equal windows
have their anchors at the same place, and every suffix that begins a match of ``WINDOW`` bytes or more shares its head
with another suffix at an anchor. A suffix array holds one entry per head: the first three bytes, then a fingerprint of
the head, and how often it occurs; it is kept in sorted runs, in the order of entries.

Documents come in batches. Each batch gets a suffix array of its own, which is merge-scanned against every level of the
family for heads that are in both; levels of equal size merge in the same scan, so a level holds 1, 2, 4, ... batches and
an entry is rewritten once per doubling. Heads that occur twice in a batch or in a batch and a level are the long matches to look at.

What they cover is then settled exactly, by strings that are counted over the whole corpus and never by pairs. If the
first and the last window of an anchor occur elsewhere, so is all between covered. Heads with an anchor where this fails
are looked at in full: their anchors' surroundings are taken once each and cut into cells of ``CELL`` windows. Windows at the
borders of cells are counted, then every window of the cells beyond the outermost that recur, where the bytes common to a
cell recur at all; windows that recur cover their bytes. The tables of bits
that tell tasks which heads and texts matter have 64 bits an entry and ``2 ** TABLE_BITS`` at most; beyond that more
entries are read than needed, with the same results.

Fingerprints have 64 bits and count only together with the head's, so two different strings are taken for one once in
some 2 ** 100 pairs. Strings never cross documents. Null and empty texts have no bytes. Repeated rows are repeats of one
another. A very long text must fit a task. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from weirflow.llm.common import fresh
from weirflow.llm.tokens import blocks
from weirflow.session import cut_lineage

WINDOW, HEAD, CELL = 400, 200, 16
BATCHES = 4
BLOCK_BYTES = 1 << 20
TABLE_BITS = 28
#: Heads that a task holds before it hands out their counts.
HELD = 1 << 20

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        size = n + n // 4 + BLOCK_BYTES
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table))
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Fingerprints:
    """Fingerprints of all substrings of ``data``: differences of one running sum, moved to the front."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:-1], out=self.sums[1:])

    def at(self, first: np.ndarray, size: int) -> np.ndarray:
        return mix((self.sums[first + size] - self.sums[first]) * self.down[first])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


class Anchors:
    """Anchors of a block of texts: text, place of the head, first and last window, all within the block, and key."""

    def __init__(self, texts: pa.Array, window: int, head: int) -> None:
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        from_, n = texts.buffers()[1], int(sizes.sum())
        first = np.frombuffer(from_, np.int32, 1, texts.offset * 4)[0] if len(texts) else 0
        self.data = np.frombuffer(texts.buffers()[2], np.uint8)[first : first + n] if n else np.zeros(0, np.uint8)
        none = np.zeros(0, np.int64)
        self.text = self.at = self.first = self.last = self.key = none
        self.prints = Fingerprints(self.data)
        many, span = n - window + 1, window - head + 1
        if many < 1:
            return
        # The smallest of each ``span`` heads: smallest so far from the left and from the right within pieces of that length.
        heads = self.prints.every(head)
        bits = U(max(1, len(heads)).bit_length())
        far = U((1 << int(bits)) - 1)
        order = (heads >> bits << bits) | (far - np.arange(len(heads), dtype=np.uint64))
        pieces = np.concatenate((order, np.full(-len(order) % span + span, ~U(0)))).reshape(-1, span)
        left = np.minimum.accumulate(pieces, axis=1).ravel()
        right = np.minimum.accumulate(pieces[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(right[:many], left[span - 1 : span - 1 + many])
        cut = np.zeros(n + 1, np.int64)  # windows that begin in the last bytes of a text would leave it
        np.add.at(cut, np.maximum(self.starts, self.ends - window + 1), 1)
        np.add.at(cut, self.ends, -1)
        whole = np.flatnonzero(np.cumsum(cut[:many]) == 0)
        if not len(whole):
            return
        at = (far - (least[whole] & far)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (whole[1:] != whole[:-1] + 1))))
        self.at, self.first, self.last = at[new], whole[new], whole[np.append(new[1:], len(whole)) - 1]
        self.text = np.searchsorted(self.ends, self.first, "right")
        three = self.data[self.at].astype(np.uint64) << U(16) | self.data[self.at + 1].astype(np.uint64) << U(8) | self.data[self.at + 2]
        self.key = (three << U(39) | heads[self.at] >> U(25)).astype(np.int64)

    def keep(self, good: np.ndarray) -> None:
        self.text, self.at, self.first, self.last, self.key = (x[good] for x in (self.text, self.at, self.first, self.last, self.key))


def text_keys(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")


def _batches(columns: dict[str, np.ndarray], step: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(next(iter(columns.values()))), step):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + step]) for c in columns.values()], list(columns))


# Tables of bits


def bit_table(places: DataFrame, entries: int) -> tuple[np.ndarray, int]:
    """Bits at the low ends of column ``place``, and how many low bits count."""
    size = min(max((64 * entries).bit_length(), 18), TABLE_BITS)
    one = F.col("place").bitwiseAND((1 << size) - 1) + 1  # the functions count from 1
    maps = places.groupBy(F.bitmap_bucket_number(one).alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits"))
    table = np.zeros(1 << size - 3, np.uint8)
    found = maps.toArrow()  # at most one row for 32,768 bits
    for no, part in zip(found.column("no").to_pylist(), found.column("bits").to_pylist()):
        table[(no - 1) * len(part) : no * len(part)] = np.frombuffer(part, np.uint8)
    return table, size


def has_bit(table: tuple[np.ndarray, int], place: np.ndarray) -> np.ndarray:
    low = place & ((1 << table[1]) - 1)
    return (table[0][low >> 3] >> (low & 7).astype(np.uint8) & 1).astype(bool)


# The family


def suffix_array(texts: DataFrame, window: int, head: int) -> DataFrame:
    """(key, n): entries of the sparse suffix array of column ``text``, in sorted runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def entries() -> Iterator[pa.RecordBatch]:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            yield from _batches({"key": key, "n": n})

        for batch in blocks(batches, "text", BLOCK_BYTES):
            held.append(Anchors(batch.column("text"), window, head).key)
            size += len(held[-1])
            if size >= HELD:
                yield from entries()
                held, size = [], 0
        if held:
            yield from entries()

    return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).sortWithinPartitions("key")


class Family:
    """Suffix arrays of 1, 2, 4, ... batches, each written to the shared folder."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []
        #: Tables (key) of heads found to occur more than once.
        self.matches: list[DataFrame] = []

    def add(self, array: DataFrame) -> None:
        """Merge a batch's suffix array with levels of its size, upwards, and scan it against the others; both find heads on two sides."""
        array, size = cut_lineage(array, "array"), 1
        self.matches.append(array.filter("n > 1").select("key"))
        batch = array
        while self.levels and self.levels[-1][0] == size:
            _, level = self.levels.pop()
            sides = level.hint("merge").join(array.withColumnRenamed("n", "m"), "key", "full_outer")
            both = F.col("n").isNotNull() & F.col("m").isNotNull()
            merged = cut_lineage(sides.select("key", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"), both.alias("met")), "level")
            self.matches.append(merged.filter("met").select("key"))
            array, size = merged.select("key", "n"), 2 * size
        for _, level in self.levels:
            self.matches.append(cut_lineage(batch.hint("merge").join(level.select("key"), "key").select("key"), "matches"))
        self.levels.append((size, array))

    def repeated(self) -> DataFrame:
        """(key) of every head that occurs more than once."""
        found = self.matches[0]
        for more in self.matches[1:]:
            found = found.unionByName(more)
        return found.distinct()


# Exact extents


def matched_anchors(texts: DataFrame, heads: tuple[np.ndarray, int], window: int, head: int) -> DataFrame:
    """(k1, k2, at, before, after, key, left, right) of anchors whose head may be repeated; before and after it lie the first and the last window's starts."""
    held = texts.sparkSession.sparkContext.broadcast(heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES):
            a = Anchors(batch.column("text"), window, head)
            a.keep(has_bit(held.value, a.key))
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False)[a.text] for c in ("k1", "k2"))
            ends = [a.prints.at(x, window).view(np.int64) for x in (a.first, a.last)]
            yield from _batches({"k1": k1, "k2": k2, "at": a.at - a.starts[a.text], "before": a.at - a.first, "after": a.at - a.last, "key": a.key, "left": ends[0], "right": ends[1]})

    return texts.mapInArrow(run, "k1 long, k2 long, at long, before long, after long, key long, left long, right long")


SAME = ["key", "left", "right", "before", "after"]


def _place(k1: Column, at: Column) -> Column:
    return k1.bitwiseXOR(at * 2654435761)


def surroundings(texts: DataFrame, chosen: DataFrame, window: int, head: int) -> DataFrame:
    """(SAME, n, around): the bytes around one anchor of each kind in ``chosen`` (SAME, n, k1, at), from its first window to the end of its last."""
    entries = chosen.count()
    places = bit_table(chosen.select(_place(F.col("k1"), F.col("at")).alias("place")), entries)
    held = texts.sparkSession.sparkContext.broadcast((places, bit_table(chosen.select(F.col("k1").alias("place")), entries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in blocks(batches, "text", BLOCK_BYTES):
            places, some = held.value
            k1 = batch.column("k1").to_numpy(zero_copy_only=False)
            use = has_bit(some, k1)
            for i in np.flatnonzero(use).tolist():  # of equal texts a task reads one
                use[i] = k1[i] not in done
                done.add(int(k1[i]))
            if not use.any():
                continue
            k1 = k1[use]
            a = Anchors(pc.take(batch.column("text"), pa.array(np.flatnonzero(use))), window, head)
            a.keep(has_bit(places, k1[a.text] ^ (a.at - a.starts[a.text]) * 2654435761))
            ends = [a.prints.at(x, window).view(np.int64) for x in (a.first, a.last)]
            data = a.data.tobytes()
            found = {"key": a.key, "left": ends[0], "right": ends[1], "before": a.at - a.first, "after": a.at - a.last}
            around = np.empty(len(a.at), object)
            around[:] = [data[i : j + window] for i, j in zip(a.first.tolist(), a.last.tolist())]
            yield from _batches(found | {"around": around}, 1 << 13)

    each = texts.select("text", "k1").mapInArrow(run, "key long, left long, right long, before long, after long, around binary")
    return each.groupBy(*SAME).agg(F.min("around").alias("around")).join(chosen.select(*SAME, "n"), SAME)


STRINGS = "id long, key long, n long, o long, size long, print long"


def _strings(around: DataFrame, picks: list[tuple[Callable[[dict, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]], int]]) -> DataFrame:
    """(id, key, n, o, size, print) for the strings that each of ``picks`` chooses (row, place in the block, offset), of its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                pieces = part.column("around").to_pylist()
                prints = Fingerprints(np.frombuffer(b"".join(pieces), np.uint8))
                columns, start = {c: part.column(c) for c in part.schema.names}, np.cumsum([0, *map(len, pieces)])[:-1]
                for pick, size in picks:
                    row, first, o = pick(columns, start)
                    own = {c: columns[c].to_numpy(zero_copy_only=False)[row] for c in ("id", "key", "n")}
                    yield from _batches(own | {"o": o, "size": np.full(len(o), size), "print": prints.at(first, size).view(np.int64)})

    return around.mapInArrow(run, STRINGS)


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of all whole numbers from ``low`` to ``high`` of each row."""
    many = high - low + 1
    row = np.repeat(np.arange(len(low)), many)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + low[row]


def covered(around: DataFrame, window: int) -> DataFrame:
    """(SAME, least, most): of each kind of anchor the smallest and the largest distance from a recurring window's start to the head.

    All windows between the two are covered by them. So of each kind the windows at the borders of its cells are counted
    first, and within cells only those outside of the borders found, in cells whose common bytes recur.
    """
    rows = cut_lineage(around.withColumn("id", F.xxhash64(*SAME)), "around")
    numbers = lambda columns, c: columns[c].to_numpy(zero_copy_only=False)

    def cells(columns: dict, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, cell = _spread(numbers(columns, "after") // CELL, numbers(columns, "before") // CELL)
        return row, start[row] + numbers(columns, "before")[row] - cell * CELL, cell

    def borders(columns: dict, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        after, before = numbers(columns, "after"), numbers(columns, "before")
        row, cell = _spread(after // CELL, before // CELL + 1)
        o = np.clip(cell * CELL, after[row], before[row])
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (o[1:] != o[:-1])))
        row, o = row[new], o[new]
        return row, start[row] + before[row] - o, o

    def inside(columns: dict, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(columns["cells"])), pc.list_value_length(columns["cells"]).to_numpy(zero_copy_only=False))
        cell = columns["cells"].flatten().to_numpy(zero_copy_only=False)
        before, after = numbers(columns, "before")[row], numbers(columns, "after")[row]
        each, o = _spread(np.maximum(cell * CELL, after), np.minimum(cell * CELL + CELL - 1, before))
        return row[each], start[row[each]] + before[each] - o, o

    string = ["key", "o", "size", "print"]

    def recurring(found: DataFrame) -> DataFrame:
        return found.join(found.groupBy(*string).agg(F.sum("n").alias("n")).filter("n > 1").select(*string), string)

    common = window - CELL + 1
    first = cut_lineage(recurring(cut_lineage(_strings(rows, [(cells, common), (borders, window)]), "cells")), "recurring")
    known = first.filter(F.col("size") == window).groupBy("id", "key").agg(F.min("o").alias("least"), F.max("o").alias("most"))
    parts = first.filter(F.col("size") == common)
    below = (F.col("least") > F.col("after")) & (F.col("o") * CELL < F.col("least"))
    above = (F.col("most") < F.col("before")) & (F.col("o") * CELL + CELL - 1 > F.col("most"))
    asked = parts.join(known, ["id", "key"], "left").join(rows.select("id", "key", "before", "after"), ["id", "key"]).filter(F.col("least").isNull() | below | above).select(*string).distinct()
    listed = parts.join(asked, string).groupBy("id", "key").agg(F.collect_list("o").alias("cells"))
    open_ = rows.select("id", "key", "n", "before", "after", "around").join(listed, ["id", "key"])
    more = recurring(cut_lineage(_strings(open_, [(inside, window)]), "windows")).groupBy("id", "key").agg(F.min("o").alias("least"), F.max("o").alias("most"))
    extents = known.unionByName(more).groupBy("id", "key").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    return rows.select("id", *SAME).join(extents, ["id", "key"]).select(*SAME, "least", "most")


def repeats(texts: DataFrame, window: int = WINDOW, head: int = HEAD, batches: int = BATCHES) -> DataFrame:
    """(k1, k2, spans) of the texts (columns text, k1, k2) with repeats: ordered starts and ends, which may overlap."""
    if not 3 <= head <= window or window - head < CELL or batches < 1:
        raise ValueError("a head has 3 bytes at least and a cell's windows fit between head and window")
    texts = texts.filter(F.octet_length("text") >= window)
    family = Family()
    for b in range(batches):
        family.add(suffix_array(texts.filter(F.pmod("k1", F.lit(batches)) == b), window, head))
    heads = cut_lineage(family.repeated(), "heads")
    table = bit_table(heads.select(F.col("key").alias("place")), heads.count())
    anchors = cut_lineage(matched_anchors(texts, table, window, head), "anchors")
    # The first and last window of each anchor; a key with one of them nowhere else is not settled by them.
    ends = anchors.select("key", F.explode(F.when(F.col("before") > F.col("after"), F.array("left", "right")).otherwise(F.array("left"))).alias("print"))
    single = ends.groupBy("key", "print").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("key").distinct()
    unsettled = single.join(heads.withColumn("again", F.lit(True)), "key", "left").withColumn("single", F.lit(True))
    marked = cut_lineage(anchors.join(unsettled, "key", "left").filter("single IS NULL OR again").drop("again"), "marked")
    looked_at = marked.filter("single")
    kinds = looked_at.groupBy(*SAME).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "at")).alias("one"))
    chosen = cut_lineage(kinds.select(*SAME, "n", "one.k1", "one.at"), "kinds")
    extents = covered(surroundings(texts, chosen, window, head), window)
    span = lambda start, end: F.struct(start.alias("start"), end.alias("end"))
    settled = marked.filter("single IS NULL").select("k1", "k2", span(F.col("at") - F.col("before"), F.col("at") - F.col("after") + window).alias("span"))
    found = looked_at.join(extents, SAME).select("k1", "k2", span(F.col("at") - F.col("most"), F.col("at") - F.col("least") + window).alias("span"))
    return settled.unionByName(found).groupBy("k1", "k2").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``kept`` (remaining bytes), ``n_bytes`` and ``removed`` (maximal runs of bytes that went, as start and end)."""
    taken = fresh(docs, "k1", "k2", "spans")
    k1, k2 = text_keys(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    texts = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), k1, k2)
    spans = repeats(texts, **options).toDF(*taken)
    joined = docs.withColumns({taken[0]: k1, taken[1]: k2}).join(spans, taken[:2], "left").drop(*taken[:2])

    @F.arrow_udf("struct<kept: binary, n_bytes: long, removed: array<struct<start: long, end: long>>>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out, done = [], []
        kind = pa.struct([("kept", pa.binary()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        for t, s in zip(texts, spans):
            data, runs, kept, at = t.as_buffer().to_pybytes() if t.is_valid else b"", [], [], 0
            for x in s.as_py() or []:
                if runs and x["start"] <= runs[-1]["end"]:
                    runs[-1]["end"] = max(runs[-1]["end"], x["end"])
                else:
                    runs.append(x)
            for x in runs:
                kept.append(data[at : x["start"]])
                at = x["end"]
            out.append({"kept": b"".join(kept) + data[at:], "n_bytes": len(data), "removed": runs})
            if len(out) == 1024:
                done.append(pa.array(out, kind))
                out = []
        return pa.concat_arrays([*done, pa.array(out, kind)])

    result = taken[2] + "_cut"
    told = joined.withColumn(result, cut(F.col(f"`{text}`").cast("string"), F.col(taken[2])))
    return told.select(*[F.col(f"`{c}`") for c in docs.columns], f"{result}.kept", f"{result}.n_bytes", f"{result}.removed")

"""Texts out of rows for queries that read messages and records: templates are put together in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows per batch of texts, each of some thousand characters.
BATCH = 1000


def chosen(ways: list, number: int | None):
    """The way of a field at ``number % 4 + 1``, as ``element_at`` and the remainder of SQL count; the last one for null."""
    if number is None:
        return ways[-1]
    at = (number % 4 if number >= 0 else -(-number % 4)) + 1
    return ways[at - 1] if at > 0 else ways[at]


def replaced(text: str, marks: dict[str, str]) -> str:
    """``text`` with every mark replaced, one after the other."""
    for mark, value in marks.items():
        text = text.replace(mark, value)
    return text


def filler(text: str, marks: list[str]) -> Callable[[dict[str, str]], str]:
    """``replaced`` for a text used by many rows: it is cut at the marks once, and each row picks its pieces.

    A value that could make up a new mark is put in by ``replaced`` itself.
    """
    pieces = re.split(f"({'|'.join(map(re.escape, marks))})", text)
    own = [*dict.fromkeys(pieces[::2])]
    at = {piece: i for i, piece in enumerate(own, len(marks))}
    picked = itemgetter(*(marks.index(x) if i % 2 else at[x] for i, x in enumerate(pieces)), 0)  # two at least give a tuple
    starts = {mark[0] for mark in marks}

    def filled(values: dict[str, str]) -> str:
        row = [values[mark] for mark in marks]
        if any(start in value for start in starts for value in row):
            return replaced(text, values)
        return "".join(picked(row + own)[:-1])

    return filled


def made(rows: DataFrame, text: Callable[[dict], str | None], name: str) -> DataFrame:
    """One row per row with the text made of it."""

    def batches(found):
        for batch in found:
            for at in range(0, batch.num_rows, BATCH):
                some = batch.slice(at, BATCH).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(map(text, some), pa.string())], [name])

    return rows.mapInArrow(batches, f"{name} string")

"""Small helpers that several operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: White space of the word definition: blank and code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text: runs of anything but ``BLANKS``; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have, so that extra columns never clash."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as the empty text, whose remainder is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def strings(values: pa.Array) -> list[bytes]:
    """The values of an Arrow string array without nulls as bytes, many times faster than one by one."""
    ends = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, values.offset * 4).tolist()
    data = values.buffers()[2].to_pybytes() if ends[-1] else b""
    return [data[a:b] for a, b in zip(ends, ends[1:])]

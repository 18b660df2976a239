"""Data checks that give the violations as rows."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.operators.filters import field_diff
from weirflow.operators.keys import join_on
from weirflow.sources.incremental import bound


def _required(kind: T.StructType, prefix: str = "") -> list[tuple[str, Column]]:
    """Tests for a null where none may be, through structs; a null parent that may be null is no fault."""
    out = []
    for f in kind.fields:
        path = f"{prefix}{f.name}"
        there = F.col(prefix[:-1]).isNotNull() if prefix else F.lit(True)
        if not f.nullable:
            out.append((path, there & F.col(path).isNull()))
        if isinstance(f.dataType, T.StructType):
            out += _required(f.dataType, f"{path}.")
    return out


def non_nullable(df: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """``(keys, column)`` for every null in a column the schema says cannot be null."""
    names = [F.when(test, F.lit(path)) for path, test in _required(schema)]
    if not names:
        return df.select(*keys, F.lit("").alias("column")).limit(0)
    return df.select(*keys, F.explode(F.array_compact(F.array(*names))).alias("column"))


def _deep_null(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        out = F.lit(True)
        for f in kind.fields:
            out = out & _deep_null(col[f.name], f.dataType)
        return col.isNull() | out
    return col.isNull()


def all_null_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows without any value at any depth."""
    test = F.lit(True)
    for f in df.schema.fields:
        if f.name not in ignore:
            test = test & _deep_null(F.col(f.name), f.dataType)
    return df.filter(test)


def null_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    test = F.lit(False)
    for k in keys:
        test = test | F.col(k).isNull()
    return df.filter(test)


def unpopulated_columns(df: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """Columns that hold no value in any row, in one pass over the table."""
    names = [c for c in df.columns if c not in allowed]
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n")) for c in names])
    return counts.select(F.inline(pairs)).filter("n = 0").select("column")


def _schema_paths(kind: T.DataType, prefix: str = "") -> tuple[set[str], set[str]]:
    """Field paths a schema covers, and prefixes below which anything is covered (maps, variants)."""
    paths, open_ends = set(), set()
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            paths.add(path)
            more, ends = _schema_paths(f.dataType, path)
            paths |= more
            open_ends |= ends
    elif isinstance(kind, T.ArrayType):
        return _schema_paths(kind.elementType, prefix)
    elif isinstance(kind, (T.MapType, T.VariantType)):
        open_ends.add(prefix)
    return paths, open_ends


#: Paths a task holds before it hands them on.
PATHS_HELD = 100_000


def _paths_of(text: str, found: set[str]) -> None:
    """Add the field paths of one record; a record that is no JSON has none."""
    def refused(name: str):
        raise ValueError(name)

    try:
        waiting = [("", json.loads(text, parse_constant=refused))]
    except (ValueError, RecursionError):
        return
    while waiting:
        prefix, value = waiting.pop()
        for item in value if isinstance(value, list) else [value]:
            if isinstance(item, dict):
                for name, inner in item.items():
                    path = f"{prefix}.{name}" if prefix else name
                    found.add(path)
                    if isinstance(inner, (dict, list)):
                        waiting.append((path, inner))


def field_paths(df: DataFrame, col: str) -> DataFrame:
    """Distinct field paths of JSON records at any depth, lists counted as the objects in them.

    One pass: a task merges the shapes of its records into one set of paths, and the sets meet in one aggregation.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[str] = set()
        told = lambda: pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())], ["path"])
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is not None:
                    _paths_of(text, found)
            if len(found) > PATHS_HELD:
                yield told()
                found.clear()
        yield told()

    return df.select(F.col(col).cast("string")).mapInArrow(run, "path string").distinct()


def uncovered_fields(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """Record field paths the schema has no place for; below a map or variant everything has one."""
    paths, ends = _schema_paths(schema)
    seen = field_paths(df, col)
    test = ~F.col("path").isin(*paths) if paths else F.lit(True)
    for end in ends:
        test = test & ~F.col("path").startswith(f"{end}.")
    return seen.filter(test)


def shape_drift(live: DataFrame, expected: DataFrame) -> DataFrame:
    """What a source lost or changed against the fields it had: missing fields and changed types."""
    return field_diff(live, expected).filter(F.col("status").isin("missing", "changed"))


def write_read_back(before: DataFrame, written: DataFrame, after: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """Faults of a write: keys that cannot be read back, and counts that did not grow as they should."""
    lost = join_on(written.select(*keys), after.select(*keys), keys, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    sides = {"old": before, "new": after, "put": written}
    each = [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(a).alias("side"), "n") for a, d in sides.items()]
    counts = each[0].unionByName(each[1]).unionByName(each[2]).agg(*[F.sum(F.when(F.col("side") == a, F.col("n"))).alias(a) for a in sides])
    wrong = F.col("new") != F.col("old") + F.col("put") if kind in ("snapshot", "append") else F.col("new") < 1
    return lost.filter("n > 0").select(F.lit("lost keys").alias("fault"), "n").unionByName(
        counts.filter(wrong).select(F.lit("row count").alias("fault"), F.col("new").alias("n"))
    )


def partitions_stable(first: DataFrame, second: DataFrame, whole: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Faults of a split: two plans that differ, rows in several partitions, rows in none.

    The frames hold the rows with the number of their ``partition``.
    """
    a, b = first.select("partition", *cols), second.select("partition", *cols)
    changed = a.exceptAll(b).agg(F.count(F.lit(1)).alias("n")).select(F.lit("plans differ").alias("fault"), "n")
    twice = first.select(*cols).exceptAll(whole.select(*cols)).agg(F.count(F.lit(1)).alias("n")).select(F.lit("read twice").alias("fault"), "n")
    never = whole.select(*cols).exceptAll(first.select(*cols)).agg(F.count(F.lit(1)).alias("n")).select(F.lit("never read").alias("fault"), "n")
    return changed.unionByName(twice).unionByName(never).filter("n > 0")


def future_rows(df: DataFrame, cursor: str, cap) -> DataFrame:
    """Rows past the cap a run started with; a read that obeys the cap holds none of them."""
    return df.filter(F.col(cursor) > bound(df, cursor, cap))

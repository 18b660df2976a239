"""Row filters and page cuts built from values that arrive as text."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.contracts import SpecError
from weirflow.functions.scalars import shape_of
from weirflow.operators.selection import key_literal, nth_key

# The comparison names.
OPERATORS = ("eq", "ne", "gt", "gte", "lt", "lte", "in")


def _type_at(schema: T.StructType, path: str) -> T.DataType:
    kind: T.DataType = schema
    for part in path.split("."):
        kind = kind[part].dataType
    return kind


def _literal(raw: str, kind: T.DataType) -> Column | None:
    """``raw`` as a value of the column's type, or None where it cannot be one."""
    if isinstance(kind, T.BooleanType):
        return F.lit(raw.lower() in ("true", "1", "yes"))
    if isinstance(kind, T.IntegralType):
        try:
            return F.lit(int(raw))
        except ValueError:
            return None
    if isinstance(kind, T.FractionalType):
        try:
            return F.lit(float(raw))
        except ValueError:
            return None
    if isinstance(kind, T.StringType):
        return F.lit(raw)
    return F.lit(raw).try_cast(kind)


def condition(schema: T.StructType, path: str, op: str, raw: str) -> Column:
    """One comparison. A null field passes only ``ne``; a value that does not fit passes nothing."""
    if op not in OPERATORS:
        raise SpecError(f"unknown operator {op}")
    col, kind = F.col(path), _type_at(schema, path)
    if op == "in":
        # Typed values, so that the test reaches the scan; those that do not fit the column match nothing.
        fit = [v for c in raw.split(",") if (v := _literal(c.strip(), kind)) is not None]
        return F.coalesce(col.isin(*fit), F.lit(False)) if fit else F.lit(False)
    value = _literal(raw, kind)
    if value is None:
        return col.isNull() if op == "ne" else F.lit(False)
    if op == "ne":
        return ~col.eqNullSafe(value)
    test = {"eq": col == value, "gt": col > value, "gte": col >= value, "lt": col < value, "lte": col <= value}[op]
    return test


def where_ops(df: DataFrame, tests: Sequence[tuple[str, str, str]]) -> DataFrame:
    for path, op, raw in tests:
        df = df.filter(condition(df.schema, path, op, raw))
    return df


def bool_tree(tree: str | dict[str, Any]) -> Column:
    """``{"type": "and"|"or"|"not"|"eq"|"gt"|"gte"|"lt"|"lte", ...}`` as one predicate."""
    node = json.loads(tree) if isinstance(tree, str) else tree
    kind = node.get("type")
    if kind in ("and", "or"):
        parts = [bool_tree(n) for n in node["value"]]
        out = F.lit(kind == "and")
        for p in parts:
            out = (out & p) if kind == "and" else (out | p)
        return out
    if kind == "not":
        return ~bool_tree(node["value"])
    col, value = F.col(node["field"]), F.lit(node["value"])
    if kind == "eq":
        return col == value
    if kind in ("gt", "gte", "lt", "lte"):
        return {"gt": col > value, "gte": col >= value, "lt": col < value, "lte": col <= value}[kind]
    raise SpecError(f"unknown node {kind}")


def tag_filters(df: DataFrame, text: str, reserved: Sequence[str] = ()) -> DataFrame:
    """A JSON object of equality filters; a list means any of its values; reserved names are refused."""
    try:
        wanted = json.loads(text)
    except json.JSONDecodeError as err:
        raise SpecError(f"filters must be a JSON object: {err}") from err
    if not isinstance(wanted, dict):
        raise SpecError("filters must be a JSON object")
    for name, value in wanted.items():
        if name in reserved:
            raise SpecError(f"{name} is reserved")
        if name not in df.columns:
            raise SpecError(f"unknown field {name}")
        df = df.filter(F.col(name).isin(value if isinstance(value, list) else [value]))
    return df


def regex_filter(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(F.col(col).rlike(pattern))


def name_filter(df: DataFrame, col: str, pattern: str, key: str, max_total: int | None = None) -> DataFrame:
    """Names by ``*`` and ``?`` wildcards, any case; rows without a key are left out; an optional total."""
    like = "".join({"*": "%", "?": "_", "%": "\\%", "_": "\\_"}.get(ch, ch) for ch in pattern)
    rows = df.filter(F.col(key).isNotNull() & F.col(col).ilike(like))
    return rows if max_total is None else rows.orderBy(key).limit(max_total)


def stable_sort(df: DataFrame, path: str, order: str = "asc", then: Sequence[str] = ()) -> DataFrame:
    """Nulls last going up, first going down."""
    col = F.col(path)
    first = col.desc_nulls_first() if order.lower() == "desc" else col.asc_nulls_last()
    return df.orderBy(first, *then)


def batch_order(df: DataFrame, *cols: str) -> DataFrame:
    """Order by text columns with null as the empty text."""
    return df.orderBy(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def slice_page(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """A page of a total order; a negative offset counts as 0, a limit below 1 gives no rows.

    The keys at both ends are selected first, so no task sorts what comes before the page; rows equal in
    every order column stay together.
    """
    first = nth_key(df, order, max(offset, 0) + 1) if limit > 0 else None
    if first is None:
        return df.limit(0)
    last, place = nth_key(df, order, max(offset, 0) + limit), F.struct(*order)
    rows = df.filter(place >= key_literal(df, order, first))
    return (rows if last is None else rows.filter(place <= key_literal(df, order, last))).orderBy(*order)


def preview(df: DataFrame, limit: int, needed: dict[str, str] | None = None, given: dict[str, str] | None = None) -> DataFrame:
    """The first rows under the table's own schema; options the table needs must be given."""
    missing = [k for k in (needed or {}) if not (given or {}).get(k)]
    if missing:
        raise SpecError(f"missing options {missing}")
    return df.limit(limit)


def top_latest(df: DataFrame, ts: str, n: int = 10, then: Sequence[str | Column] = ()) -> DataFrame:
    """The newest ``n`` rows; ``then`` decides among rows of one moment."""
    return df.orderBy(F.col(ts).desc(), *then).limit(n)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames one below the other; columns a frame lacks are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def record_fields(df: DataFrame, col: str) -> DataFrame:
    """Top-level fields of JSON records as ``(field, type)``: the shapes a field has over all rows, nulls left out."""
    entries = F.map_entries(F.try_variant_get(F.try_parse_json(F.col(col)), "$", "map<string,variant>"))
    rows = df.select(F.explode(entries).alias("e")).select(F.col("e.key").alias("field"), shape_of(F.col("e.value")).alias("shape"))
    known = F.array_sort(F.collect_set(F.when(F.col("shape") != "null", F.col("shape"))))
    return rows.groupBy("field").agg(F.nullif(F.array_join(known, "|"), F.lit("")).alias("type"))


def field_diff(live: DataFrame, expected: DataFrame) -> DataFrame:
    """Per field ``missing``, ``extra``, ``changed`` or ``common``; both sides are ``(field, type)`` rows, a null type fits any."""
    a, b = live.alias("a"), expected.alias("b")
    same = F.coalesce(F.col("a.type") == F.col("b.type"), F.lit(True))
    kind = F.when(F.col("a.field").isNull(), "missing").when(F.col("b.field").isNull(), "extra").when(same, "common").otherwise("changed")
    both = a.join(b, F.col("a.field") == F.col("b.field"), "full_outer")
    return both.select(F.coalesce("a.field", "b.field").alias("field"), kind.alias("status"), F.col("b.type").alias("expected_type"), F.col("a.type").alias("live_type"))

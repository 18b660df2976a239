"""Counts, catalogs and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.scalars import first_word_or_unknown


def type_catalog(points: DataFrame, descriptor: str, units: str) -> DataFrame:
    """Points per first word of the descriptor and unit, most frequent first."""
    kind = first_word_or_unknown(F.col(descriptor)).alias("point_type")
    unit = F.trim(F.coalesce(F.col(units), F.lit(""))).alias("engineering_units")
    out = points.groupBy(kind, unit).agg(F.count(F.lit(1)).alias("count_points"))
    return out.orderBy(F.desc("count_points"), "point_type", "engineering_units")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def group_span(facts: DataFrame, keys: Sequence[str], first: str, last: str) -> DataFrame:
    """Per group the number of rows, the earliest and the latest time."""
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("message_count"), F.max(last).alias("latest_message"), F.min(first).alias("oldest_message"))


def merge_span(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`group_span` results of finer groups put together, so names are joined to counts and not to rows."""
    return counts.groupBy(*keys).agg(
        F.sum("message_count").alias("message_count"), F.max("latest_message").alias("latest_message"), F.min("oldest_message").alias("oldest_message")
    )


def top_groups(df: DataFrame, count: str, latest: str, n: int, then: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(count), F.desc(latest), *then).limit(n)


def max_cursor(df: DataFrame, parsed: Column) -> DataFrame:
    """Largest parsed time; unreadable ones do not count."""
    return df.agg(F.max(parsed).alias("cursor"))


def dedupe_full_row(df: DataFrame) -> DataFrame:
    """Identical rows once. Maps cannot be compared, so they are compared by their sorted entries."""
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    if not maps:
        return df.dropDuplicates()
    sides = {f"_m_{m}": F.array_sort(F.map_entries(m)) for m in maps}
    plain = [c for c in df.columns if c not in maps]
    rows = df.withColumns(sides).drop(*maps).dropDuplicates()
    return rows.select(*plain, *[F.map_from_entries(f"_m_{m}").alias(m) for m in maps]).select(*df.columns)


# Identity fields in the order they are tried.
IDENTITY_FIELDS = ("id", "sha", "uuid", "node_id", "name")


def best_key(df: DataFrame, declared: Sequence[str] = ()) -> Column:
    """The row's identity: the first identity field with a value, else the declared fields, else the whole row."""
    tried = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in IDENTITY_FIELDS if c in df.columns]
    if declared:
        there = F.lit(True)
        for c in declared:
            there = there & F.col(c).isNotNull()
        tried.append(F.when(there, F.to_json(F.struct(*declared))))
    return F.coalesce(*tried, F.sha2(F.to_json(F.struct(*df.columns)), 256))


def dedupe_by_best_key(df: DataFrame, order: Sequence[str], declared: Sequence[str] = ()) -> DataFrame:
    """The first row of every identity."""
    rank = F.struct(*order, F.xxhash64(*df.columns).alias("_h"))
    best = df.groupBy(best_key(df, declared).alias("_k")).agg(F.min_by(F.struct(*df.columns), rank).alias("_b"))
    return best.select("_b.*")

"""The n-th smallest key of a table without sorting up to it.

Keys are dealt over range partitions, a histogram of the table; the counts of the partitions tell which
one holds the n-th key, and only that partition's rows are dealt out again, until they are few or all
alike. A pass brings one row per partition to the driver, so the number of passes is the logarithm of the
table's size to the base of the number of partitions, whatever n is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Rows that may be sorted in one task to find the last place.
FEW = 20_000

Key = list[str | None]


def key_literal(df: DataFrame, order: Sequence[str], key: Key) -> Column:
    """A key, held as text, in the types of its columns."""
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, key)])


def nth_key(df: DataFrame, order: Sequence[str], n: int) -> Key | None:
    """The smallest key, as text by column, at or below which there are ``n`` rows (nulls first); None if there are fewer."""
    rows, place = df.select(*order), F.struct(*order)
    wanted = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = lambda side: F.array(*[F.col(side)[c].cast("string") for c in order]).alias(side)
    left = max(n, 1)
    while True:
        dealt = rows.repartitionByRange(wanted, *order).groupBy(F.spark_partition_id().alias("part"))
        parts = sorted(dealt.agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("low"), F.max(place).alias("high")).select("part", "n", texts("low"), texts("high")).collect())
        held = None
        for held in parts:
            if left <= held["n"]:
                break
            left -= held["n"]
        else:
            return None
        low, high = key_literal(df, order, held["low"]), key_literal(df, order, held["high"])
        if held["low"] == held["high"]:
            return held["low"]
        inside = rows.filter((place >= low) & (place <= high))
        if held["n"] <= FEW:
            return inside.orderBy(*order).limit(left).agg(F.max(place).alias("high")).select(texts("high")).head()["high"]
        if len(parts) == 1:
            # The sample set one of two neighbours apart from nothing: take the smallest key away by itself.
            alike = rows.filter(place == low).count()
            if left <= alike:
                return held["low"]
            left, inside = left - alike, rows.filter((place > low) & (place <= high))
        rows = inside

"""Joins on key columns where null keys match null keys, and rows for ranges of numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by key; the left keys are kept. Null-safe equality is still an equi-join for Spark."""
    side = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = left.join(side, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_k{i}" for i in range(len(keys))])


def each_between(df: DataFrame, low: Column, high: Column, name: str, per: int = 1024) -> DataFrame:
    """A row for every whole number from ``low`` to ``high``, in two steps, so that no row holds a long list."""
    blocks = df.withColumns({"_low": low.cast("long"), "_high": high.cast("long")}).filter("_low <= _high")
    blocks = blocks.withColumn("_block", F.explode(F.sequence(F.floor(F.col("_low") / per), F.floor(F.col("_high") / per))))
    first, last = F.greatest("_low", F.col("_block") * per), F.least(F.col("_high"), F.col("_block") * per + (per - 1))
    return blocks.withColumn(name, F.explode(F.sequence(first, last))).drop("_low", "_high", "_block")

"""Order-dependent steps as a prefix scan that stays balanced when one key holds a large part of the rows.

A window partitioned by key alone puts a hot key, or a table without key, into one task. Here one range
shuffle deals the rows out by key and order, and the task a row lands in is its chunk: a hot key fills
several chunks, small keys share one, and only rows equal in every key and order column stay together.
The rows are written to the shared folder with their chunk, so that every step over the same order reads
them from there and finds the same chunks again. A step works inside (chunk, key); what goes over a border
between chunks concerns the last key of a chunk alone, so one summary row per chunk is scanned and joined
back. Nothing of this reaches the driver, and no summary grows with the number of keys.

There are ``spark.weirflow.chunks`` chunks, or as many as the session has shuffle partitions (which
adaptive execution lowers for little data). Callers that take several steps over one order lay the rows
out once with :func:`lay_out`; steps keep its ``_chunk`` column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from weirflow.session import cut_lineage

CHUNK = "_chunk"


def lay_out(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_chunk``: chunk after chunk holds ascending (keys, order), nulls first."""
    wanted = df.sparkSession.conf.get("spark.weirflow.chunks", None)
    dealt = df.repartitionByRange(int(wanted), *keys, *order) if wanted else df.repartitionByRange(*keys, *order)
    return cut_lineage(dealt.withColumn(CHUNK, F.spark_partition_id()), "line")


def _laid(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df if CHUNK in df.columns else lay_out(df, keys, order)


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


def _carried(edges: DataFrame, ahead: bool) -> DataFrame:
    """(chunk, key, value) at the border of each chunk, moved on to the next chunk (``ahead``: the one before)."""
    side = W.orderBy(F.col(CHUNK).desc() if ahead else F.col(CHUNK).asc())
    return edges.select(CHUNK, F.lag(F.struct("_edge_key", "_edge")).over(side).alias("_carry"))


def _of_carry(keys: Sequence[str], name: str) -> Column:
    """A value carried into the chunk, where it belongs to the row's key."""
    return F.when(F.col("_carry._edge_key").eqNullSafe(_key(keys)), F.col("_carry._edge")[name])


def with_neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], ahead: bool = True) -> DataFrame:
    """Add each of ``values`` taken from the next (or previous) row of the same key."""
    rows = _laid(df, keys, order).withColumn("_pack", F.struct(*[v.alias(n) for n, v in values.items()]))
    pick, step = (F.min_by, F.lead) if ahead else (F.max_by, F.lag)
    edge = pick(F.struct(_key(keys).alias("k"), F.col("_pack").alias("v")), F.struct(_key(keys).alias("k"), *order))
    edges = rows.groupBy(CHUNK).agg(edge.alias("_e")).select(CHUNK, F.col("_e.k").alias("_edge_key"), F.col("_e.v").alias("_edge"))
    near = rows.withColumn("_near", step("_pack").over(W.partitionBy(CHUNK, *keys).orderBy(*order)))
    joined = near.join(_carried(edges, ahead), CHUNK, "left")
    best = lambda n: F.when(F.col("_near").isNotNull(), F.col("_near")[n]).otherwise(_of_carry(keys, n))
    return joined.select(*_kept(df, rows), *[best(n).alias(n) for n in values])


def with_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], ahead: bool = False) -> DataFrame:
    """Add each value as last seen non-null at or before the row (``ahead``: first at or after it)."""
    rows = _laid(df, keys, order).select("*", *[v.alias(f"_v_{n}") for n, v in values.items()])
    # Looking ahead is looking back over the reversed order: a frame that grows, not one that shrinks.
    line = [F.col(c).desc() if ahead else F.col(c).asc() for c in order]
    inside = W.partitionBy(CHUNK, *keys).orderBy(*line).rowsBetween(W.unboundedPreceding, 0)
    pick, place = F.min_by if ahead else F.max_by, F.struct(_key(keys).alias("k"), *order)
    last = lambda n: pick(F.struct(_key(keys).alias("k"), F.col(f"_v_{n}").alias("v")), F.when(F.col(f"_v_{n}").isNotNull(), place))
    found = rows.groupBy(CHUNK).agg(pick(_key(keys), place).alias("_edge_key"), *[last(n).alias(n) for n in values])
    # The chunk's last value counts if it is one of the chunk's last key; a key that fills whole chunks hands on what it had before.
    along = W.partitionBy("_edge_key").orderBy(F.col(CHUNK).desc() if ahead else F.col(CHUNK).asc()).rowsBetween(W.unboundedPreceding, 0)
    held = [F.last(F.when(F.col(n)["k"].eqNullSafe(F.col("_edge_key")), F.col(n)["v"]), ignorenulls=True).over(along).alias(n) for n in values]
    edges = found.select(CHUNK, "_edge_key", F.struct(*held).alias("_edge"))
    near = rows.select("*", *[F.last(f"_v_{n}", ignorenulls=True).over(inside).alias(f"_n_{n}") for n in values])
    joined = near.join(_carried(edges, ahead), CHUNK, "left")
    return joined.select(*_kept(df, rows), *[F.coalesce(F.col(f"_n_{n}"), _of_carry(keys, n)).alias(n) for n in values])


def with_running(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Add running sums per key up to and including the row."""
    rows = _laid(df, keys, order).select("*", *[v.alias(f"_v_{n}") for n, v in sums.items()])
    inside = W.partitionBy(CHUNK, *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    near = rows.select("*", *[F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)).alias(f"_n_{n}") for n in sums])
    ends = F.max_by(F.struct(_key(keys).alias("k"), *[F.col(f"_n_{n}").alias(n) for n in sums]), F.struct(_key(keys).alias("k"), *order))
    found = near.groupBy(CHUNK).agg(ends.alias("_e")).select(CHUNK, F.col("_e.k").alias("_edge_key"), *[F.col("_e")[n].alias(n) for n in sums])
    along = W.partitionBy("_edge_key").orderBy(CHUNK).rowsBetween(W.unboundedPreceding, 0)
    edges = found.select(CHUNK, "_edge_key", F.struct(*[F.sum(n).over(along).alias(n) for n in sums]).alias("_edge"))
    joined = near.join(_carried(edges, False), CHUNK, "left")
    return joined.select(*_kept(df, rows), *[(F.col(f"_n_{n}") + F.coalesce(_of_carry(keys, n), F.lit(0))).alias(n) for n in sums])


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 1-based place of each row within its key; ``order`` must be total."""
    return with_running(df, keys, order, {name: F.lit(1)})


def _kept(df: DataFrame, rows: DataFrame) -> list[Column]:
    return [rows[c] for c in df.columns]

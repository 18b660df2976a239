"""Connected components by alternating large and small stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weirflow.session import cut_lineage


#: Edges that one task settles faster than a shuffle can deal them out.
FEW_EDGES = 20_000


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))


def _stars(neighbours: DataFrame, larger: bool, few: bool) -> DataFrame:
    """Edges (a, b), a > b: each node's neighbours (the larger ones, or all with itself) move to its smallest neighbour."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = neighbours.join(least, "u")
    if larger:
        out = moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return (out.coalesce(1) if few else out).filter("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``: root is the smallest node that can be reached. Loops and repeats do no harm."""
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    state, before = cut_lineage(pairs, "edges"), None
    while True:
        size = state.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if size["n"] == 0 or (size["n"], size["x"]) == before:
            break
        before, few = (size["n"], size["x"]), size["n"] <= FEW_EDGES
        large = _stars(_both(state.coalesce(1) if few else state), True, few)
        state = cut_lineage(_stars(large.select(F.col("a").alias("u"), F.col("b").alias("v")), False, few), "edges")
    stars = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())

"""Merkle manifest of a dataset with nested-interval labels.

Every row is a leaf; the leaves of a group are ranked by their order column, and a node carries the interval
[lo, hi) of leaf ranks that it covers. ``fanout`` consecutive nodes have one parent, a last run of fewer ones too, until
a group has one node left, its subroot. The subroots, ranked by group, are the leaves of one more tree of the same make.

A node of level k lies in one bucket of ``fanout ** k`` ranks, so it meets its parent by an equality join on the group and
the bucket of the level above, where the parent's interval must contain its own. A parent knows the intervals of its
children; those that differ from a child's own are its siblings. Attached from the root downwards, every leaf gets the
siblings of all its ancestors, which prove it.

Ranks come from one range shuffle: a row's place in its task, plus the rows of the group in the tasks before it, so a
group may hold any share of the rows and only counts per task and group are scanned.

Null groups come first, null order values first in their group; a null id counts as the empty text where ids are
hashed. Ties in the order column go by leaf; repeated rows are a leaf each. Null and empty texts give different leaves.
A leaf alone in its group is the subroot. An empty table gives empty results; other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.session import cut_lineage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as bytes that cannot be taken for another: its length, a colon, itself; a dash for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def parent(children: Column) -> Column:
    """Digest over the digests of an array of nodes, in order."""
    return F.sha2(F.array_join(F.transform(children, lambda c: c["digest"]), "").cast("binary"), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``lo``, the place of a row in its group, ``hi`` = lo + 1 and ``total``, the rows of the group."""
    keys = [group, *order, "_salt"]
    dealt = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut_lineage(dealt.drop("_salt").withColumn("_place", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_place", 33)), "ranked")
    parts = placed.groupBy(group, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    by = Window.partitionBy(group)
    before = F.sum("_n").over(by.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = cut_lineage(parts.select(group, "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(by).alias("total")), "ranks")
    lo = F.col("_place") - F.col("_first") + F.col("_before")
    return placed.join(parts, [group, "_part"]).withColumn("lo", lo).withColumn("hi", lo + 1).drop("_place", "_part", "_first", "_before")


def levels(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Nodes of level 1, 2, ...: (label, lo, hi, total, digest, children), each level written to the shared folder."""
    if fanout < 2:
        raise ValueError("a node needs room for two children")
    most = leaves.agg(F.max("total")).first()[0] or 0
    below, out, width = leaves, [], 1
    while width < most:
        # A group whose nodes of the level below are one already has its subroot there.
        runs = below.filter(F.col("total") > width).withColumn("bucket", F.expr(f"lo div {width * fanout}"))
        children = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))
        made = runs.groupBy("label", "bucket").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("total").alias("total"), children.alias("children"))
        below = cut_lineage(made.select("label", "lo", "hi", "total", parent(F.col("children")).alias("digest"), "children"), "nodes")
        out.append(below)
        width *= fanout
    return out


def tops(leaves: DataFrame, nodes: list[DataFrame]) -> DataFrame:
    """(label, level, digest) of the node that covers a whole group."""
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("total"))
    found = [df.filter(whole & (F.col("total") > F.lit(1) if level else F.col("total") == 1)).select("label", F.lit(level).alias("level"), "digest") for level, df in enumerate([leaves, *nodes])]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def attach(nodes: DataFrame, above: DataFrame, width: int) -> DataFrame:
    """``nodes`` with ``path``: siblings beside each node and beside its ancestors; ``above`` holds the level over it, ``width`` ranks a node."""
    up = above.select("label", F.expr(f"lo div {width}").alias("bucket"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), F.col("children").alias("run"), F.col("path").alias("up_path"), "crown")
    inside = (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))
    joined = nodes.withColumn("bucket", F.expr(f"lo div {width}")).join(up, ["label", "bucket"]).filter(inside)
    digests = lambda keep: F.array_join(F.transform(F.filter("run", keep), lambda c: c["digest"]), "")
    beside = F.struct(digests(lambda c: c["hi"] <= F.col("lo")).alias("left"), digests(lambda c: c["lo"] >= F.col("hi")).alias("right"))
    return joined.withColumn("path", F.concat(F.array(beside), "up_path")).drop("bucket", "up_lo", "up_hi", "run", "up_path")


def descend(leaves: DataFrame, nodes: list[DataFrame], crowns: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``leaves`` with ``path`` and ``crown``; ``crowns`` (label, level, path, crown) says how each group's top goes on."""
    above = None
    for level in range(len(nodes), -1, -1):
        here = nodes[level - 1] if level else leaves
        top = here.filter((F.col("lo") == 0) & (F.col("hi") == F.col("total"))).join(crowns.filter(F.col("level") == level).drop("level"), "label")
        above = top if above is None else top.unionByName(attach(here, above, fanout ** (level + 1)).select(top.columns))
    return above


@dataclass
class Manifest:
    """Leaves (label, id, leaf as digest, lo, hi, total), nodes of every level, subroots (label, level, subroot, path, root)."""

    leaves: DataFrame
    nodes: list[DataFrame]
    crowns: DataFrame
    fanout: int

    def proofs(self) -> DataFrame:
        """Columns of ``leaves``, ``path`` and ``crown`` (subroot, root) of every leaf."""
        return descend(self.leaves, self.nodes, self.crowns, self.fanout)


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT, carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``carry`` adds columns to the leaves by name."""
    # A letter before each group keeps their order and puts null first.
    label = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    own = leaf(*[F.col(f"`{f}`") for f in fields])
    rows = cut_lineage(docs.select(label.alias("label"), F.col(f"`{order}`").alias("id"), own.alias("digest"), *[v.alias(k) for k, v in (carry or {}).items()]), "leaves")
    leaves = ranked(rows, "label", ["id", "digest"])
    nodes = levels(leaves, fanout)
    subroots = cut_lineage(tops(leaves, nodes), "subroots")
    second = ranked(subroots.select(F.lit("").alias("label"), F.col("label").alias("of"), F.col("level").alias("of_level"), "digest"), "label", ["of"])
    upper = levels(second, fanout)
    root = tops(second, upper).select("label", "level", F.expr("CAST(array() AS array<struct<left: string, right: string>>)").alias("path"), F.col("digest").alias("crown"))
    proven = descend(second, upper, root, fanout)
    crowns = cut_lineage(proven.select(F.col("of").alias("label"), F.col("of_level").alias("level"), "path", F.struct(F.col("digest").alias("subroot"), F.col("crown").alias("root")).alias("crown")), "crowns")
    return Manifest(leaves, nodes, crowns, fanout)


def proof(path: Column) -> Column:
    """One digest over all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]).cast("binary"), 256))

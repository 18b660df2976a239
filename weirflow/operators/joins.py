"""Joins: parents with children, enrichment, as-of values, overlapping intervals, id look-ups.

Sides are left to Catalyst and AQE, which broadcast by measured size and split a partition that
one key makes too large. What can be counted before a join is counted before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.operators.keys import each_between, join_on
from weirflow.operators.ordered import with_fill
from weirflow.sources.incremental import bound


def fan_out_children(parents: DataFrame, children: DataFrame, key: Sequence[str], copy: Sequence[str] = ()) -> DataFrame:
    """Children of known parents with the parent's columns copied on."""
    return children.join(parents.select(*key, *copy), list(key))


def left_enrich(facts: DataFrame, dims: DataFrame, on: Column, cols: Sequence[str]) -> DataFrame:
    """Facts with columns of a dimension, null where it has no row."""
    return facts.join(dims, on, "left").select(*facts.columns, *cols)


def reply_counts(messages: DataFrame, replies: DataFrame, key: str, parent: str, latest: str) -> DataFrame:
    """Messages that have replies, with the number and the latest time of them."""
    per = replies.groupBy(F.col(parent).alias("_p")).agg(F.count(F.lit(1)).alias("reply_count"), F.max(latest).alias("latest_reply"))
    return messages.join(per, F.col(key) == F.col("_p")).drop("_p")


def metadata_attach(rows: DataFrame, metadata: DataFrame, key: str, col: str) -> DataFrame:
    """The metadata of each row's id, null where there is none."""
    return rows.join(metadata.select(key, col), key, "left")


def inherit_parent(children: DataFrame, parents: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """A child's own value, else its parent's."""
    up = parents.select(key, *[F.col(c).alias(f"_p_{c}") for c in cols])
    own = [c for c in children.columns if c not in cols]
    joined = children.join(up, key, "left")
    return joined.select(*own, *[F.coalesce(c, f"_p_{c}").alias(c) if c in children.columns else F.col(f"_p_{c}").alias(c) for c in cols])


def asof_value(points: DataFrame, values: DataFrame, keys: Sequence[str], at: str, ts: str, col: str) -> DataFrame:
    """Points with the last value of their key at or before them, and its time; null where there is none.

    Both sides are laid in one line per key and the values are carried forward, so no pairs are
    formed; long lines are cut into chunks.
    """
    cols = [c for c in points.columns if c not in (*keys, at)]
    left = points.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*cols, F.lit(0).alias("_x")).alias("_row"))
    right = values.select(*keys, F.col(ts).alias("_t"), F.lit(0).alias("_side"), F.struct(F.col(col).alias("v"), F.col(ts).alias("t")).alias("_val"))
    line = left.unionByName(right, allowMissingColumns=True)
    filled = with_fill(line, keys, ["_t", "_side"], {"_last": F.col("_val")})
    return filled.filter(F.col("_side") == 1).select(
        *keys, F.col("_t").alias(at), *[F.col("_row")[c].alias(c) for c in cols],
        F.col("_last")["v"].alias(col), F.col("_last")["t"].alias(f"{col}_at"),
    )


def value_at(values: DataFrame, keys: Sequence[str], ts: str, col: str, moment) -> DataFrame:
    """Per key the last value at or before one moment."""
    upto = values.filter(F.col(ts) <= bound(values, ts, moment))
    best = upto.groupBy(*keys).agg(F.max(F.struct(F.col(ts).alias("t"), F.col(col).alias("v"))).alias("b"))
    return best.select(*keys, F.col("b.v").alias(col), F.col("b.t").alias(ts))


def overlapping(frames: DataFrame, start: str, end: str, low, high) -> DataFrame:
    """Frames that overlap ``[low, high]``; a frame without end is still going on."""
    a, b = F.col(start), F.col(end)
    return frames.filter((a <= bound(frames, start, high)) & (b.isNull() | (b >= bound(frames, end, low))))


def _nodes(first: Column, last: Column, levels: int) -> Column:
    """The fewest nodes (level, number) of a binary hierarchy over slots that cover ``first`` to ``last``: two a level at most.

    At a level the nodes wholly inside reach from ``a`` to ``b``; an odd ``a`` and an even ``b`` are no halves of a
    node inside on the level above.
    """
    found = []
    for n in range(levels + 1):
        width = 1 << n
        a, b = F.floor((first + (width - 1)) / width), F.floor((last + 1) / width) - 1
        node = lambda k: F.struct(F.lit(n).alias("level"), k.cast("long").alias("node"))  # noqa: B023, E731
        found += [F.when((a <= b) & (a % 2 == 1), node(a)), F.when((a <= b) & (b % 2 == 0), node(b))]
    return F.array_compact(F.array(*found))


def _ancestors(slot: Column, levels: int) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("level"), F.floor(slot / (1 << n)).cast("long").alias("node")) for n in range(levels + 1)])


def overlap_pairs(
    frames: DataFrame, spans: DataFrame, frame: tuple[str, str], span: tuple[str, str], bucket_seconds: int,
) -> DataFrame:
    """Every frame with every span it overlaps; a frame without end is still going on.

    Two intervals overlap if one begins inside the other. Time slots form a binary hierarchy: an interval lies on the
    fewest nodes that cover its slots, some two a level, and a beginning on the nodes above its slot, so a frame of a
    year takes tens of rows and not one per slot. A beginning meets an interval on one node only, and what begins first
    is told apart, so nothing has to be made distinct. The joins have no order to keep, so adaptive execution splits a
    node on which very many frames or spans lie.
    """
    size = bucket_seconds * 1_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    # The spans' outer bounds keep frames without end from being laid on nodes no span reaches.
    edge = spans.agg(F.min(micros(span[0])).alias("lo"), F.max(micros(span[1])).alias("hi")).head()
    if edge["lo"] is None or edge["hi"] is None:
        return frames.limit(0).join(spans.limit(0), F.lit(True)).select(*frames.columns, *spans.columns)
    low, high = F.lit(edge["lo"]).cast("bigint"), F.lit(edge["hi"]).cast("bigint")
    levels = max(0, (edge["hi"] - edge["lo"]) // size).bit_length()
    slot = lambda m: F.floor((m - low) / F.lit(size))
    left = frames.withColumns({
        "_fa": F.greatest(micros(frame[0]), low), "_fb": F.least(F.coalesce(micros(frame[1]), high), high),
    }).filter(F.col("_fa") <= F.col("_fb"))
    right = spans.withColumns({"_sa": micros(span[0]), "_sb": micros(span[1])}).filter(F.col("_sa") <= F.col("_sb"))
    on = lambda df, nodes: df.select("*", F.inline(nodes))
    kept = [*frames.columns, *spans.columns]
    inside = on(left, _nodes(slot(F.col("_fa")), slot(F.col("_fb")), levels)).join(on(right, _ancestors(slot(F.col("_sa")), levels)), ["level", "node"])
    inside = inside.filter((F.col("_fa") <= F.col("_sa")) & (F.col("_sa") <= F.col("_fb"))).select(*kept)
    around = on(left, _ancestors(slot(F.col("_fa")), levels)).join(on(right, _nodes(slot(F.col("_sa")), slot(F.col("_sb")), levels)), ["level", "node"])
    around = around.filter((F.col("_sa") < F.col("_fa")) & (F.col("_fa") <= F.col("_sb"))).select(*kept)
    return inside.unionByName(around)



def primary_or_referenced(frames: DataFrame, links: DataFrame, key: str, primary: str, element: str) -> DataFrame:
    """Per frame its primary element, and the other elements it names, labelled."""
    main = frames.filter(F.coalesce(F.col(primary).cast("string"), F.lit("")) != "").select(
        key, F.col(primary).alias(element), F.lit("primary").alias("relationship_type")
    )
    other = links.join(frames.select(key, F.col(primary).alias("_main")), key)
    other = other.filter(F.col(element).isNotNull() & ~F.col(element).eqNullSafe(F.col("_main")))
    return main.unionByName(other.select(key, element, F.lit("referenced").alias("relationship_type")))


def tombstone_anti(rows: DataFrame, tombstones: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_on(rows, tombstones.select(*keys), keys, "left_anti")


def ids_missing(written: DataFrame, read: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Written keys the read does not hold; no rows means all are present."""
    return join_on(written.select(*keys), read.select(*keys), keys, "left_anti")


def fetch_by_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of a set of ids."""
    return rows.join(ids.select(key), key, "left_semi")


def resolve_pairs(pairs: DataFrame, messages: DataFrame, keys: Sequence[str], message_id: str, explicit: str | None = None) -> DataFrame:
    """``(team, channel)`` pairs with all their message ids, or with one id given."""
    if explicit is not None:
        return pairs.select(*keys).withColumn(message_id, F.lit(explicit))
    return pairs.select(*keys).join(messages.select(*keys, message_id), list(keys))

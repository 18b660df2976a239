"""Time series keyed by (tag, timestamp): recorded, interpolated, plotted, summarised, current values.

A value holds until the tag's next sample. Steps that look at neighbours use the chunked form of
:mod:`weirflow.operators.ordered`, so a tag with very many samples is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions.scalars import as_bool, try_float
from weirflow.operators.keys import each_between
from weirflow.operators.ordered import lay_out, with_fill, with_neighbour
from weirflow.sources.incremental import bound, text_of

# Summary names.
SUMMARIES = ("Total", "Average", "Minimum", "Maximum", "Range", "StdDev", "Count")


def _micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))


def _moment(value: Any) -> int:
    """Epoch microseconds of a zone-free UTC moment."""
    at = value if isinstance(value, datetime) else datetime.fromisoformat(text_of(value))
    gap = at - datetime(1970, 1, 1)
    return (gap.days * 86400 + gap.seconds) * 1_000_000 + gap.microseconds


def _stamp(micros: Column) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def ts_recorded(df: DataFrame, start: Any = None, end: Any = None, ts: str = "timestamp") -> DataFrame:
    """Samples in ``[start, end]``: a bad number is null, ``good`` is true and the other flags false unless
    given, samples without time are left out."""
    rows = df.filter(F.col(ts).isNotNull())
    if start is not None:
        rows = rows.filter(F.col(ts) >= bound(df, ts, start))
    if end is not None:
        rows = rows.filter(F.col(ts) <= bound(df, ts, end))
    cols = {"value": try_float(F.col("value"))}
    for flag, default in (("good", True), ("questionable", False), ("substituted", False), ("annotated", False)):
        cols[flag] = as_bool(F.col(flag), default) if flag in df.columns else F.lit(default)
    cols["units"] = F.coalesce(F.col("units"), F.lit("")) if "units" in df.columns else F.lit("")
    return rows.withColumns(cols)


def ts_interpolate(df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any, step_seconds: int = 60) -> DataFrame:
    """Linear values on a regular grid over ``[start, end]``; null before the first and after the last sample."""
    size = step_seconds * 1_000_000
    data = df.select(F.col(tag).alias("tag"), _micros(F.col(ts)).alias("t"), F.col(value).cast("double").alias("v"))
    data = data.filter(F.col("t").isNotNull() & F.col("v").isNotNull())
    # First the days, then the points of a day, so no row holds a long list.
    low, high = _moment(start), _moment(end)
    points = (high - low) // size + 1
    per = max(1, 86_400_000_000 // size)
    blocks = df.select(F.col(tag).alias("tag")).distinct().select("tag", F.explode(F.sequence(F.lit(0), F.lit((points - 1) // per))).alias("_b"))
    grid = blocks.select("tag", F.explode(F.sequence(F.col("_b") * per, F.least((F.col("_b") + 1) * per, F.lit(points)) - 1)).alias("_n"))
    grid = grid.select("tag", (F.col("_n").cast("bigint") * size + low).alias("t"))
    line = data.withColumn("_grid", F.lit(False)).unionByName(grid.withColumn("_grid", F.lit(True)), allowMissingColumns=True)
    line = lay_out(line, ["tag"], ["t", "_grid"])
    sample = F.when(~F.col("_grid"), F.struct("t", "v"))
    line = with_fill(line, ["tag"], ["t", "_grid"], {"_before": sample})
    # A sample on the grid point itself sorts before it going forward; going back it is the one before.
    line = with_fill(line, ["tag"], ["t", "_grid"], {"_after": sample}, ahead=True)
    a, b, t = F.col("_before"), F.col("_after"), F.col("t")
    on_point = a["t"] == t
    linear = a["v"] + (b["v"] - a["v"]) * (t - a["t"]) / (b["t"] - a["t"])
    got = F.when(on_point, a["v"]).when(a.isNotNull() & b.isNotNull(), linear)
    return line.filter("_grid").select(F.col("tag").alias(tag), _stamp(t).alias(ts), got.alias(value))


def ts_plot(df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any, intervals: int) -> DataFrame:
    """At most ``intervals`` intervals, of each the first, last, smallest and largest sample, once each."""
    low, high = _moment(start), _moment(end)
    width = -(-(high - low) // intervals)
    t = _micros(F.col(ts))
    rows = df.filter((t >= low) & (t <= high) & F.col(value).isNotNull())
    slot = F.least(F.floor((t - low) / F.lit(width)), F.lit(intervals - 1)).alias("_slot")
    by_time, by_value = F.struct(t.alias("t"), F.col(value).alias("v")), F.struct(F.col(value).alias("v"), t.alias("t"))
    # Of equal extremes the earliest is taken.
    early_top = F.struct(F.col(value).alias("v"), (-t).alias("nt"))
    best = rows.groupBy(F.col(tag), slot).agg(
        F.min(by_time).alias("first"), F.max(by_time).alias("last"), F.min(by_value).alias("low"), F.max(early_top).alias("top")
    )
    pair = lambda v, at: F.struct(at.alias("t"), v.alias("v"))
    points = F.array_distinct(F.array(
        pair(F.col("first.v"), F.col("first.t")), pair(F.col("last.v"), F.col("last.t")),
        pair(F.col("low.v"), F.col("low.t")), pair(F.col("top.v"), -F.col("top.nt")),
    ))
    out = best.select(F.col(tag), F.explode(points).alias("p"))
    return out.select(tag, _stamp(F.col("p.t")).alias(ts), F.col("p.v").alias(value)).distinct()


def _weighted(df: DataFrame, tag: str, ts: str, value: str, low: int, high: int, size: int | None) -> DataFrame:
    """Held pieces ``(tag, bucket, v, w seconds)`` of every sample inside ``[low, high)``."""
    rows = df.select(F.col(tag).alias("tag"), _micros(F.col(ts)).alias("t"), F.col(value).cast("double").alias("v"))
    rows = rows.filter(F.col("t").isNotNull() & F.col("v").isNotNull() & (F.col("t") < high))
    held = with_neighbour(rows, ["tag"], ["t"], {"_next": F.col("t")})
    held = held.select("tag", "v", F.greatest(F.col("t"), F.lit(low)).alias("a"), F.least(F.coalesce("_next", F.lit(high)), F.lit(high)).alias("b"))
    held = held.filter(F.col("a") < F.col("b"))
    if size is None:
        return held.select("tag", F.lit(low).alias("bucket"), "v", ((F.col("b") - F.col("a")) / 1_000_000).alias("w"))
    number = lambda c: F.floor((c - low) / F.lit(size))
    parts = each_between(held, number(F.col("a")), number(F.col("b") - 1), "n")
    left = F.col("n") * size + low
    inside = F.least(F.col("b"), left + size) - F.greatest(F.col("a"), left)
    return parts.select("tag", left.alias("bucket"), "v", (inside / 1_000_000).alias("w"))


def ts_summary(
    df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any, types: Sequence[str] = ("Total",),
    duration_seconds: int | None = None, basis: str = "TimeWeighted",
) -> DataFrame:
    """Summaries per tag and duration bucket over ``[start, end)`` as ``(tag, summary_type, timestamp, value)``.

    TimeWeighted: a value counts for as long as it holds, also where it was sampled before ``start``.
    Average and StdDev weigh by seconds, Total is value times days, Count is seconds covered.
    EventWeighted: every sample counts once; Total is the sum, StdDev that of a sample.
    """
    unknown = [t for t in types if t not in SUMMARIES]
    if unknown or basis not in ("TimeWeighted", "EventWeighted"):
        raise ValueError(f"unknown summary {unknown or basis}")
    low, high = _moment(start), _moment(end)
    size = duration_seconds * 1_000_000 if duration_seconds else None
    v, w = F.col("v"), F.col("w")
    if basis == "TimeWeighted":
        rows = _weighted(df, tag, ts, value, low, high, size)
        mean = F.sum(v * w) / F.sum(w)
        made = {
            "Total": F.sum(v * w) / 86400, "Average": mean, "Count": F.sum(w),
            "StdDev": F.sqrt(F.greatest(F.sum(v * v * w) / F.sum(w) - mean * mean, F.lit(0.0))),
        }
    else:
        t = _micros(F.col(ts))
        bucket = F.lit(low) if size is None else F.floor((t - low) / F.lit(size)) * size + low
        rows = df.filter((t >= low) & (t < high) & F.col(value).isNotNull()).select(F.col(tag).alias("tag"), bucket.alias("bucket"), F.col(value).cast("double").alias("v"))
        made = {"Total": F.sum(v), "Average": F.avg(v), "Count": F.count(v).cast("double"), "StdDev": F.stddev_samp(v)}
    made |= {"Minimum": F.min(v), "Maximum": F.max(v), "Range": F.max(v) - F.min(v)}
    wide = rows.groupBy("tag", "bucket").agg(*[made[t].alias(t) for t in types])
    long = wide.unpivot(["tag", "bucket"], list(types), "summary_type", "value")
    return long.select(F.col("tag").alias(tag), "summary_type", _stamp(F.col("bucket")).alias("timestamp"), "value")


def ts_calculated(
    df: DataFrame, tag: str, ts: str, value: str, start: Any, end: Any, calc: str = "Average", interval_seconds: int = 60,
    basis: str = "TimeWeighted",
) -> DataFrame:
    """One calculation per interval."""
    return ts_summary(df, tag, ts, value, start, end, [calc], interval_seconds, basis).drop("summary_type")


def ts_current(df: DataFrame, tag: str, ts: str) -> DataFrame:
    """The latest sample of every tag."""
    body = [c for c in df.columns if c != tag]
    rank = F.struct(F.col(ts), F.xxhash64(*body).alias("h"))
    return df.groupBy(tag).agg(F.max_by(F.struct(*body), rank).alias("_b")).select(tag, "_b.*")

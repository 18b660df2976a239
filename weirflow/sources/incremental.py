"""Incremental reads: each takes a table and an offset and gives the new rows and the next offset.

Offsets are plain dicts of strings. A reader that finds nothing new gives its offset back
unchanged, so a loop ends when the end offset equals the start offset. Filters compare the raw
column with a literal of its own type, so they reach the Parquet scan; batch limits look up a
cutoff first and then filter by it, so the batch itself is read in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.functions.scalars import normalize_iso
from weirflow.operators.changes import one_per_key
from weirflow.operators.keys import join_on
from weirflow.operators.ordered import with_running
from weirflow.operators.selection import key_literal, nth_key

Offset = dict[str, str]


def text_of(value: Any) -> str | None:
    """Offset form of a cursor value."""
    if value is None:
        return None
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    return str(value)


def bound(df: DataFrame, name: str, value: Any) -> Column:
    """A literal of the column's own type."""
    return F.lit(text_of(value)).cast(df.schema[name].dataType)


def cursor_key(df: DataFrame, name: str, col: Column) -> Column:
    """What cursors are compared by: text that is a time by its moment, whatever its offset, other text before it as text."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        return col
    moment = normalize_iso(col)
    return F.struct(moment.alias("moment"), F.when(moment.isNull(), col).alias("text"))


def _moment(value: Any) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(str(value))


def _head(df: DataFrame, *aggs: Column) -> Any:
    return df.agg(*aggs).head()


def _largest(name: str) -> Column:
    return F.max(name).cast("string")


def snapshot_scan(
    spark: SparkSession, path: str, schema: Any = None, filters: dict[str, Any] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The whole table, with optional equality filters."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    return equality(df, filters)


def equality(df: DataFrame, filters: dict[str, Any] | None) -> DataFrame:
    for name, value in (filters or {}).items():
        df = df.filter(F.col(name).isNull() if value is None else F.col(name) == bound(df, name, value))
    return df


def cursor_scan(
    df: DataFrame,
    cursor: str,
    since: Any = None,
    until: Any = None,
    filters: dict[str, Any] | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Rows with ``since < cursor <= until``. A null cursor is kept only when ``since`` is open."""
    col = F.col(cursor)
    if since is not None:
        df = df.filter(col > bound(df, cursor, since))
    if until is not None:
        inside = col <= bound(df, cursor, until)
        df = df.filter(inside if since is not None else (inside | col.isNull()))
    df = equality(df, filters)
    return df.orderBy(col.asc_nulls_first()) if ordered else df


def admit_batch(df: DataFrame, cursor: str, max_records: int, since: Any = None) -> tuple[DataFrame, Offset]:
    """About ``max_records`` rows, extended to the end of the last run of equal cursors.

    Rows without a cursor have no place in that order and are left out, so a run of them cannot hold up the rest.
    """
    col = F.col(cursor)
    rows = cursor_scan(df, cursor, since).filter(col.isNotNull())
    key = nth_key(rows, [cursor], max_records)
    cut = key[0] if key else _head(rows, _largest(cursor).alias("c"))["c"]
    if cut is None:
        return rows.limit(0), {} if since is None else {"cursor": text_of(since)}
    return rows.filter(col <= bound(df, cursor, cut)), {"cursor": cut}


def keyset_scan(
    df: DataFrame,
    cursor: str,
    tiebreak: str | None,
    offset: Offset | None = None,
    max_records: int | None = None,
    cap: Any = None,
) -> tuple[DataFrame, Offset]:
    """Rows strictly after the ``(cursor, tiebreak)`` pair of the offset, in that order, up to ``cap``.

    Without a unique tie-break column rows sharing a cursor could be lost between batches, so its
    absence, and a null in it, is an error. Text cursors that are times are compared as moments.
    """
    if not tiebreak:
        raise ValueError("keyset_scan needs a unique tie-break column; read the table as a snapshot instead")
    start = offset or {}
    c, t = F.col(cursor), F.col(tiebreak)
    limit = lambda value: cursor_key(df, cursor, bound(df, cursor, value))
    rows, place = df.filter(c.isNotNull()), c
    if isinstance(df.schema[cursor].dataType, T.StringType):
        # One-element explode: the filters below use the key made here instead of making it each anew.
        rows, place = rows.select("*", F.explode(F.array(cursor_key(df, cursor, c))).alias("_place")), F.col("_place")
    if cap is not None:
        rows = rows.filter(place <= limit(cap))
    if start.get("cursor") is not None:
        low = limit(start["cursor"])
        if start.get("tiebreak") is not None:
            rows = rows.filter((place > low) | ((place == low) & (t > bound(df, tiebreak, start["tiebreak"]))))
        else:
            rows = rows.filter(place > low)
    batch = rows.select(cursor, tiebreak, place.alias("_key"))
    if max_records is not None:
        parts = ["_key.moment", "_key.text"] if isinstance(batch.schema["_key"].dataType, T.StructType) else ["_key"]
        keyed = batch.select("*", *[F.col(p).alias(f"_k{i}") for i, p in enumerate(parts)])
        order = [*[f"_k{i}" for i in range(len(parts))], tiebreak]
        key = nth_key(keyed, order, max_records)
        batch = keyed.filter(F.struct(*order) <= key_literal(keyed, order, key)) if key else keyed
    last = F.max_by(F.struct(c.cast("string").alias("c"), t.cast("string").alias("t")), F.struct(F.col("_key"), t)).alias("last")
    seen = _head(batch, last, F.count_if(t.isNull()).alias("bad"), F.count(F.lit(1)).alias("n"))
    if seen["bad"]:
        raise ValueError(f"tie-break column {tiebreak} holds nulls")
    if not seen["n"]:
        return rows.limit(0).select(*df.columns), dict(start)
    end_c, end_t = seen["last"]["c"], seen["last"]["t"]
    top = limit(end_c)
    inside = rows.filter((place < top) | ((place == top) & (t <= bound(df, tiebreak, end_t))))
    return inside.select(*df.columns), {"cursor": end_c, "tiebreak": end_t}


def peek_bounds(df: DataFrame, cursor: str) -> DataFrame:
    """Oldest and newest cursor, one row."""
    return df.agg(F.min(cursor).alias("oldest"), F.max(cursor).alias("newest"))


def caught_up(df: DataFrame, cursor: str, checkpoint: Any) -> bool:
    """True only when the newest cursor lies below the checkpoint; an equal one must still be read."""
    return bool(_head(df, (F.max(cursor) < bound(df, cursor, checkpoint)).alias("done"))["done"])


def _start_of(df: DataFrame, cursor: str, offset: Offset | None) -> tuple[str | None, bool]:
    """Lower bound and whether it is itself to be read (only on a first run, from the oldest row)."""
    if offset and offset.get("cursor") is not None:
        return offset["cursor"], False
    return _head(df, F.min(cursor).cast("string").alias("c"))["c"], True


def _slice(df: DataFrame, cursor: str, low: Any, high: Any, with_low: bool) -> DataFrame:
    col, edge = F.col(cursor), bound(df, cursor, low)
    return df.filter(col >= edge if with_low else col > edge).filter(col <= bound(df, cursor, high))


def window_scan(
    df: DataFrame,
    cursor: str,
    offset: Offset | None,
    window_seconds: int = 3600,
    cap: Any = None,
    max_records: int | None = None,
) -> tuple[DataFrame, Offset]:
    """One window ``(since, min(since + w, cap)]``.

    A drained window moves the offset to its end even when empty; a row cap inside the window
    moves it to the last row's cursor, with equal cursors kept together.
    """
    low, with_low = _start_of(df, cursor, offset)
    if low is None or (cap is not None and _moment(low) >= _moment(cap)):
        return df.limit(0), dict(offset or {})
    high = _moment(low) + timedelta(seconds=window_seconds)
    if cap is not None:
        high = min(high, _moment(cap))
    rows = _slice(df, cursor, low, high, with_low)
    if max_records is not None:
        key = nth_key(rows, [cursor], max_records)
        if key and _moment(key[0]) < high:
            return rows.filter(F.col(cursor) <= bound(df, cursor, key[0])), {"cursor": key[0]}
    return rows, {"cursor": text_of(high)}


def multi_window_scan(
    df: DataFrame, cursor: str, offset: Offset | None, window_seconds: int, cap: Any, max_records: int
) -> tuple[DataFrame, Offset]:
    """Whole windows one after the other until the row budget is met or ``cap`` is reached."""
    low, with_low = _start_of(df, cursor, offset)
    if low is None or _moment(low) >= _moment(cap):
        return df.limit(0), dict(offset or {})
    rows = _slice(df, cursor, low, cap, with_low)
    micros = F.unix_micros(F.col(cursor).cast("timestamp")) - F.unix_micros(bound(df, cursor, low).cast("timestamp"))
    number = F.when(micros <= 0, F.lit(0)).otherwise(F.floor((micros - 1) / F.lit(window_seconds * 1_000_000)))
    counts = rows.select(number.cast("long").alias("win")).groupBy("win").agg(F.count(F.lit(1)).alias("n"))
    run = with_running(counts, [], ["win"], {"total": F.col("n")})
    found = _head(run, F.min(F.when(F.col("total") >= max_records, F.col("win"))).alias("stop"), F.max("total").alias("n"))
    if not found["n"]:
        return df.limit(0), dict(offset) if offset else {"cursor": low}
    end = _moment(cap)
    if found["stop"] is not None:
        end = min(end, _moment(low) + timedelta(seconds=window_seconds * (found["stop"] + 1)))
    return rows.filter(F.col(cursor) <= bound(df, cursor, end)), {"cursor": text_of(end)}


def hourly_window_scan(
    df: DataFrame, ts: str, offset: Offset | None, window_hours: int, lag_hours: int, now: Any
) -> tuple[DataFrame, Offset]:
    """Hours ``[start, end]``, both included; data younger than ``lag_hours`` is not ready yet.

    The offset holds the next hour to read, one past the last one taken.
    """
    ceiling = _moment(now).replace(minute=0, second=0, microsecond=0) - timedelta(hours=lag_hours)
    if offset and offset.get("hour"):
        start = _moment(offset["hour"])
    else:
        oldest = _head(df, F.date_trunc("hour", F.min(ts)).cast("string").alias("h"))["h"]
        if oldest is None:
            return df.limit(0), dict(offset or {})
        start = _moment(oldest)
    if start > ceiling:
        return df.limit(0), dict(offset or {"hour": text_of(start)})
    end = min(start + timedelta(hours=window_hours - 1), ceiling)
    after = end + timedelta(hours=1)
    col = F.col(ts)
    return df.filter((col >= bound(df, ts, start)) & (col < bound(df, ts, after))), {"hour": text_of(after)}


def day_window_scan(
    df: DataFrame, day: str, offset: Offset, window_days: int, lookback_days: int, upper: Any
) -> tuple[DataFrame, Offset]:
    """One run of days. A window that is not the last ends a day before the next one starts; the
    last one includes ``upper``, which may lie ahead of today. The lookback widens the read only."""
    start, last = _moment(offset["day"]).date(), _moment(upper).date()
    if start > last:
        return df.limit(0), dict(offset)
    after = start + timedelta(days=window_days)
    end = min(after - timedelta(days=1), last)
    first = start - timedelta(days=lookback_days)
    col = F.col(day)
    inside = (col >= bound(df, day, first)) & (col < bound(df, day, end + timedelta(days=1)))
    return df.filter(inside), {"day": str(end + timedelta(days=1))}


def lookback(since: Any, **delta: float) -> str | None:
    """The lower bound moved back (``seconds=300``, ``hours=6``, ``days=3``) to read late rows again."""
    return None if since is None else text_of(_moment(since) - timedelta(**delta))


def next_offset(df: DataFrame, cursor: str, current: Any = None, init_cap: Any = None) -> DataFrame:
    """One row ``cursor``: the largest value, never past ``init_cap`` and never before ``current``."""
    top = F.max(cursor)
    if init_cap is not None:
        top = F.least(top, bound(df, cursor, init_cap))
    if current is not None:
        top = F.greatest(top, bound(df, cursor, current))
    return df.agg(top.alias("cursor"))


def keyed_watermarks(
    df: DataFrame, keys: Sequence[str], cursor: str, marks: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Per key the rows above its own watermark (all rows of a key without one) and the new watermarks.

    ``marks`` has the key columns and ``watermark``. The join is left to AQE: it broadcasts the
    watermarks when their measured size allows.
    """
    if marks is None:
        return df, df.groupBy(*keys).agg(F.max(cursor).alias("watermark"))
    rows = join_on(df, marks.select(*keys, F.col("watermark").alias("_mark")), keys, "left")
    rows = rows.filter(F.col("_mark").isNull() | (F.col(cursor) > F.col("_mark"))).drop("_mark").select(*df.columns)
    both = rows.select(*keys, F.col(cursor).alias("watermark")).unionByName(marks.select(*keys, "watermark"))
    return rows, both.groupBy(*keys).agg(F.max("watermark").alias("watermark"))


def _moment_of(cursor: str, token: str | None) -> Column:
    return F.struct(F.col(cursor).alias("c"), *([F.col(token).alias("t")] if token else []))


def past_marks(df: DataFrame, keys: Sequence[str], cursor: str, marks: DataFrame, token: str | None = None) -> DataFrame:
    """Rows past the mark of their key, and all rows of a key without one; see :func:`newest_marks`."""
    mark = F.struct(F.col("watermark").alias("c"), *([F.col("token").alias("t")] if token else []))
    rows = join_on(df, marks.select(*keys, mark.alias("_mark")), keys, "left")
    return rows.filter(F.col("_mark").isNull() | (_moment_of(cursor, token) > F.col("_mark"))).select(*df.columns)


def newest_marks(df: DataFrame, keys: Sequence[str], cursor: str, token: str | None = None) -> DataFrame:
    """Per key ``watermark``, its largest cursor, and with a ``token`` column the largest ``token`` at that cursor."""
    best = df.filter(F.col(cursor).isNotNull()).groupBy(*keys).agg(F.max(_moment_of(cursor, token)).alias("_best"))
    return best.select(*keys, F.col("_best.c").alias("watermark"), *([F.col("_best.t").alias("token")] if token else []))


def changed_parents(
    parents: DataFrame, children: DataFrame, key: str | Sequence[str], parent_cursor: str, child_cursor: str,
    since: Any, cap: Any = None,
) -> DataFrame:
    """Children with ``since < child_cursor <= cap`` whose parent changed after ``since``."""
    names = [key] if isinstance(key, str) else list(key)
    changed = cursor_scan(parents, parent_cursor, since).select(*names)
    return cursor_scan(children, child_cursor, since, cap).join(changed, names, "left_semi")


def plan_time_partitions(
    spark: SparkSession, start: Any, end: Any, days: int = 1, lookback_minutes: int = 0
) -> DataFrame:
    """Slices ``(lower, upper]`` covering ``(start, end]``; none when start is not before end; one open
    slice on a first run (start missing or not after the year 2000)."""
    shape = "lower timestamp_ntz, upper timestamp_ntz"
    if start is None or _moment(start) <= datetime(2000, 1, 1):
        one = F.struct(F.lit(None).cast("timestamp_ntz").alias("lower"), F.lit(text_of(end)).cast("timestamp_ntz").alias("upper"))
        return spark.range(1).select(one.alias("s")).select("s.*").select("lower", "upper")
    low, high = _moment(start) - timedelta(minutes=lookback_minutes), _moment(end)
    if _moment(start) >= high:
        return spark.createDataFrame([], shape)
    step = F.expr(f"interval {int(days)} days")
    first, last = F.lit(text_of(low)).cast("timestamp_ntz"), F.lit(text_of(high)).cast("timestamp_ntz")
    starts = spark.range(1).select(F.explode(F.sequence(first, last, step)).alias("lower"))
    return starts.filter(F.col("lower") < last).select("lower", F.least(F.col("lower") + step, last).alias("upper"))


def with_slice(df: DataFrame, cursor: str, start: Any, end: Any, days: int = 1, lookback_minutes: int = 0) -> DataFrame:
    """Rows of ``(start, end]`` with the ``lower`` end of their slice of :func:`plan_time_partitions`, by arithmetic on the row."""
    low = F.lit(text_of(_moment(start) - timedelta(minutes=lookback_minutes))).cast("timestamp_ntz")
    at, width = F.unix_micros(F.col(cursor).cast("timestamp_ntz").cast("timestamp")), int(days) * 86_400_000_000
    number = F.floor((at - F.unix_micros(low.cast("timestamp")) - 1) / width)
    inside = df.filter((F.col(cursor) > low) & (F.col(cursor) <= F.lit(text_of(end)).cast("timestamp_ntz")))
    return inside.withColumn("lower", low + F.make_dt_interval(days=(number * int(days)).cast("int")))


def in_slice(cursor: str, lower: Any, upper: Any) -> Column:
    """``{lower TO upper]``: the lower end is outside, the upper end inside; a null end is open."""
    col = F.col(cursor)
    return (F.lit(lower).isNull() | (col > lower)) & (F.lit(upper).isNull() | (col <= upper))


def balance_bins(df: DataFrame, weight: str, order: str, n: int) -> DataFrame:
    """Add ``bin`` 0..n-1 by running weight (null or zero counts 1); bins that get nothing do not appear."""
    w = F.when(F.coalesce(F.col(weight), F.lit(0)) <= 0, F.lit(1)).otherwise(F.col(weight)).cast("double")
    run = with_running(df.withColumn("_w", w), [], [order], {"_run": F.col("_w")})
    total = _head(df, F.sum(w).alias("t"))["t"] or 1.0
    before = F.col("_run") - F.col("_w")
    number = F.least(F.floor(before * F.lit(n) / F.lit(total)), F.lit(n - 1)).cast("int")
    return run.withColumn("bin", number).drop("_w", "_run")


def full_list_refresh(df: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> tuple[DataFrame, Offset]:
    """Everything again, replacing rows of the target by key; of a key listed twice the larger row hash stays. The offset is a fixed marker."""
    fresh = one_per_key(df, keys)
    if target is None:
        return fresh, {"done": "true"}
    kept = join_on(target, fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh), {"done": "true"}


def assert_newer(df: DataFrame, cursor: str, since: Any) -> None:
    """Raise when a read that should be newer than ``since`` holds dated rows but none above it."""
    col = F.col(cursor)
    seen = _head(df, F.count(col).alias("dated"), F.count_if(col > bound(df, cursor, since)).alias("newer"))
    if seen["dated"] and not seen["newer"]:
        raise ValueError(f"no row is newer than {since}: the source ignored the filter")


def keep_undated(df: DataFrame, ts: str, start: Any) -> DataFrame:
    """Rows at or after ``start`` and rows without a readable time."""
    col = F.col(ts)
    return df.filter(col.isNull() | (col >= bound(df, ts, start)))


def two_part_offset(
    df: DataFrame, cursor: str, offset: Offset | None, max_records: int, cap: Any
) -> tuple[DataFrame, Offset]:
    """Offset ``{start_time, resume_after}``: a resume mark wins while a walk is under way, and the cap
    bounds ``start_time`` only once the walk has reached the end."""
    start = offset or {}
    resume, begun = start.get("resume_after"), start.get("start_time")
    if resume is None and begun is not None and _moment(begun) >= _moment(cap):
        return df.limit(0), dict(start)
    low = resume if resume is not None else begun
    rows, end = admit_batch(df.filter(F.col(cursor).isNotNull()), cursor, max_records, low)
    if not end or end.get("cursor") == low:
        return df.limit(0), dict(start)
    last = end["cursor"]
    more = _head(cursor_scan(df, cursor, last).select(cursor).limit(1), F.count(F.lit(1)).alias("n"))["n"]
    if more:
        return rows, {"start_time": last, "resume_after": last}
    return rows, {"start_time": text_of(min(_moment(last), _moment(cap)))}


def limit_plus_one(
    df: DataFrame, cursor: str, tiebreak: str, n: int, since: Any = None, cap: Any = None
) -> tuple[DataFrame, Offset, bool]:
    """The first ``n`` rows by ``(cursor, tiebreak)``; whether there are more decides on truncation.

    Only a batch that was not cut may move the offset to ``cap``; an empty first run moves there too.
    """
    rows = cursor_scan(df, cursor, since).filter(F.col(cursor).isNotNull())
    c, t = F.col(cursor), F.col(tiebreak)
    seen = _head(rows, F.count(F.lit(1)).alias("n"), _largest(cursor).alias("last"))
    if not seen["n"]:
        end = text_of(since) if since is not None else text_of(cap)
        return rows.limit(0), {"cursor": end} if end else {}, False
    if seen["n"] > n:
        at, tie = nth_key(rows, [cursor, tiebreak], n)
        top, tie = bound(df, cursor, at), bound(df, tiebreak, tie)
        return rows.filter((c < top) | ((c == top) & (t <= tie))), {"cursor": at}, True
    last = seen["last"]
    if cap is not None and _moment(last) > _moment(cap):
        last = text_of(_moment(cap))
    return rows, {"cursor": last}, False


def per_parent_budget(df: DataFrame, parent: str, n: int) -> DataFrame:
    """All rows of parents taken in order until ``n`` rows are reached; no parent is split."""
    counts = df.groupBy(parent).agg(F.count(F.lit(1)).alias("_n"))
    run = with_running(counts, [], [parent], {"_run": F.col("_n")})
    taken = run.filter(F.col("_run") - F.col("_n") < n).select(parent)
    return df.join(taken, parent, "left_semi")


def tombstone_scan(df: DataFrame, cursor: str, since: Any = None) -> DataFrame:
    """Deleted rows above ``since``."""
    if cursor not in df.columns:
        raise ValueError(f"the tombstone table has no column {cursor}")
    return cursor_scan(df, cursor, since)


def skip_failed_parents(df: DataFrame, failed: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of the parents that could be read, and the failed ones apart for the log."""
    bad = F.coalesce(failed, F.lit(False))
    return df.filter(~bad), df.filter(bad)


def default_time_range(
    now: datetime,
    offset: Offset | None = None,
    start: Any = None,
    end: Any = None,
    lookback_minutes: int = 60,
    max_window_minutes: int | None = None,
) -> tuple[datetime, datetime]:
    """Bounds of a time read: offset, else the start option, else a lookback; never past ``now``."""
    high = min(_moment(end) if end is not None else now, now)
    if offset and offset.get("cursor"):
        low = _moment(offset["cursor"])
    else:
        low = _moment(start) if start is not None else high - timedelta(minutes=lookback_minutes)
    low = min(low, now)
    if max_window_minutes:
        high = min(high, low + timedelta(minutes=max_window_minutes))
    return low, high


def resume_after_page(df: DataFrame, stream: str, ts: str) -> DataFrame:
    """One row ``resume_at``: the smallest of the per-stream last times, plus one microsecond."""
    last = df.groupBy(stream).agg(F.max(ts).alias("_last"))
    return last.agg((F.min("_last") + F.expr("interval 1 microsecond")).alias("resume_at"))

"""Product analytics: active users, sessions, cohorts, answer counts.

Sessions are cut where a user pauses longer than ``gap_seconds`` (30 minutes unless given). Events are
first summed into slots as long as the gap, which can never hold a cut; that step combines on
the map side, however many events one user has. A user has at most ``time span / gap`` slots, so
the window over slots has a known bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

GAP = 1800


def _slot(ts: str, gap_seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(gap_seconds * 1_000_000))


def _session_slots(events: DataFrame, user: str, ts: str, gap_seconds: int) -> DataFrame:
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slots = events.groupBy(F.col(user), _slot(ts, gap_seconds).alias("_slot")).agg(
        F.min(micros).alias("_a"), F.max(micros).alias("_b"), F.count(F.lit(1)).alias("_n"),
        F.min(ts).alias("_start"), F.max(ts).alias("_end"),
    )
    line = W.partitionBy(user).orderBy("_slot")
    opens = F.coalesce((F.col("_a") - F.lag("_b").over(line) > gap_seconds * 1_000_000).cast("int"), F.lit(1))
    return slots.withColumn("_opens", opens).withColumn("session_no", F.sum("_opens").over(line))


def sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", gap_seconds: int = GAP) -> DataFrame:
    """One row per session: user, number, start, end, events, seconds."""
    slots = _session_slots(events, user, ts, gap_seconds)
    return slots.groupBy(user, "session_no").agg(
        F.min("_start").alias("start_time"), F.max("_end").alias("end_time"), F.sum("_n").alias("events"),
        ((F.max("_b") - F.min("_a")) / 1_000_000).alias("seconds"),
    )


def sessionize(events: DataFrame, user: str = "user_id", ts: str = "ts", gap_seconds: int = GAP) -> DataFrame:
    """Events with the number of their session; the join runs by (user, slot), which spreads a busy user."""
    slots = _session_slots(events, user, ts, gap_seconds).select(F.col(user).alias("_u"), F.col("_slot").alias("_s"), "session_no")
    rows = events.withColumn("_slot", _slot(ts, gap_seconds))
    joined = rows.join(slots, F.col(user).eqNullSafe(F.col("_u")) & (F.col("_slot") == F.col("_s")))
    return joined.select(*events.columns, "session_no")


def session_avg_length(events: DataFrame, gap_seconds: int = GAP, **cols) -> DataFrame:
    """Mean session seconds per day of the session's start."""
    return sessions(events, gap_seconds=gap_seconds, **cols).groupBy(F.to_date("start_time").alias("date")).agg(F.avg("seconds").alias("length"))


def session_histogram(events: DataFrame, edges: Sequence[int], gap_seconds: int = GAP, **cols) -> DataFrame:
    """Sessions per length bucket ``[edge, next edge)`` in seconds; the last bucket is open."""
    length = F.col("seconds")
    label = F.lit(None).cast("string")
    for low, high in zip(edges, [*edges[1:], None]):
        inside = (length >= low) if high is None else (length >= low) & (length < high)
        label = F.when(inside, F.lit(f"{low}+" if high is None else f"{low}-{high}")).otherwise(label)
    return sessions(events, gap_seconds=gap_seconds, **cols).groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))


def sessions_per_user(events: DataFrame, gap_seconds: int = GAP, **cols) -> DataFrame:
    """Mean sessions per user and day."""
    user = cols.get("user", "user_id")
    per = sessions(events, gap_seconds=gap_seconds, **cols).groupBy(F.to_date("start_time").alias("date"), user).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy("date").agg(F.avg("_n").alias("avg_sessions"))


# Interval lengths in days and the calendar unit each stands for.
INTERVALS = {1: "day", 7: "week", 30: "month"}


def active_users(
    events: DataFrame, mode: str = "active", interval: int = 1, segment: Column | None = None,
    user: str = "user_id", ts: str = "ts",
) -> DataFrame:
    """Distinct users per interval and segment; ``new`` counts a user where first seen."""
    if mode not in ("active", "new") or interval not in INTERVALS:
        raise ValueError("mode must be active or new, interval 1, 7 or 30")
    label = (F.lit("Totals") if segment is None else segment).alias("segment")
    day = F.date_trunc(INTERVALS[interval], F.col(ts)).cast("date").alias("date")
    if mode == "active":
        return events.select(day, label, F.col(user)).groupBy("date", "segment").agg(F.count_distinct(user).alias("count"))
    first = events.select(day, label, F.col(user), F.col(ts).alias("_t")).groupBy(user).agg(
        F.min(F.struct("_t", "date", "segment")).alias("f")
    )
    return first.groupBy(F.col("f.date").alias("date"), F.col("f.segment").alias("segment")).agg(F.count(F.lit(1)).alias("count"))


def cohort_members(profiles: DataFrame, rules: dict[str, Column], user: str) -> DataFrame:
    """``(cohort, user)`` for every rule a profile meets."""
    names = [F.when(test, F.lit(name)) for name, test in rules.items()]
    rows = profiles.select(F.col(user), F.explode(F.array_compact(F.array(*names))).alias("cohort"))
    return rows.select("cohort", user).distinct()


def survey_rollup(responses: DataFrame, answers: str, survey: str) -> DataFrame:
    """Number of responses per survey, question and choice; ``answers`` maps a question to its choice."""
    rows = responses.select(survey, F.explode(answers).alias("question", "choice"))
    return rows.groupBy(survey, "question", "choice").agg(F.count(F.lit(1)).alias("responses"))

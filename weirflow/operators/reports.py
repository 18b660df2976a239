"""Dimension and metric reports over an event log, with named presets and incremental re-reads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.contracts import SpecError
from weirflow.operators.keys import join_on
from weirflow.operators.sessions import sessionize
from weirflow.sources.incremental import bound

MAX_DIMENSIONS, MAX_METRICS, LOOKBACK_DAYS = 9, 10, 3

# The named reports with all their options.
PRESETS = {
    "traffic_by_country": {
        "dimensions": ["date", "country"],
        "metrics": ["activeUsers", "sessions", "screenPageViews"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "user_acquisition": {
        "dimensions": ["date", "sessionSource", "sessionMedium"],
        "metrics": ["sessions", "activeUsers", "newUsers", "engagementRate"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "events_summary": {
        "dimensions": ["date", "eventName"],
        "metrics": ["eventCount", "activeUsers"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "page_performance": {
        "dimensions": ["date", "pagePath", "pageTitle"],
        "metrics": ["screenPageViews", "averageSessionDuration", "bounceRate"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "device_breakdown": {
        "dimensions": ["date", "deviceCategory", "browser"],
        "metrics": ["activeUsers", "sessions", "engagementRate"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "landing_page_performance": {
        "dimensions": ["date", "landingPage"],
        "metrics": ["sessions", "activeUsers", "newUsers", "keyEvents", "totalRevenue"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "ecommerce_purchases": {
        "dimensions": ["date", "itemName", "itemId"],
        "metrics": ["itemsViewed", "itemsAddedToCart", "itemsPurchased", "itemRevenue"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "purchase_journey": {
        "dimensions": ["date", "eventName"],
        "metrics": ["activeUsers", "eventCount"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "checkout_journey": {
        "dimensions": ["date", "eventName"],
        "metrics": ["activeUsers", "eventCount"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "promotions_performance": {
        "dimensions": ["date", "itemPromotionName"],
        "metrics": ["itemsViewedInPromotion", "itemsClickedInPromotion", "itemRevenue"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "user_retention": {
        "dimensions": ["date", "newVsReturning"],
        "metrics": ["activeUsers", "sessions", "engagementRate"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "demographic_details": {
        "dimensions": ["date", "language", "country"],
        "metrics": ["activeUsers", "newUsers", "engagedSessions"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "audience_performance": {
        "dimensions": ["date", "audienceName"],
        "metrics": ["activeUsers", "sessions", "keyEvents"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "tech_details": {
        "dimensions": ["date", "browser", "operatingSystem"],
        "metrics": ["activeUsers", "sessions", "engagementRate"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
    "advertising_channels": {
        "dimensions": ["date", "defaultChannelGroup"],
        "metrics": ["keyEvents", "advertiserAdCost", "totalRevenue"],
        "start_date": "30daysAgo", "lookback_days": "3",
    },
}


def event_metrics(user: str = "user_id", kind: str = "event_type", value: str = "value") -> dict[str, Column]:
    """Metrics an event log can give."""
    bought = F.col(kind) == "purchase"
    revenue = F.sum(F.when(bought, F.col(value)).otherwise(0.0))
    return {
        "activeUsers": F.count_distinct(user),
        "eventCount": F.count(F.lit(1)),
        "screenPageViews": F.count_if(F.col(kind) == "view"),
        "keyEvents": F.count_if(F.col(kind).isin(*KEY_EVENTS)),
        "itemsViewed": F.count_if(F.col(kind) == "view"),
        "itemsPurchased": F.count_if(bought),
        "itemRevenue": revenue,
        "totalRevenue": revenue,
    }


KEY_EVENTS = ("purchase", "signup")
ENGAGED_SECONDS = 10


def with_visits(events: DataFrame, user: str = "user_id", ts: str = "ts", kind: str = "event_type") -> DataFrame:
    """Events with their session: ``visit`` (its number, seconds, whether engaged) and whether it is the user's first.

    A session is engaged if it lasts over ten seconds, holds a key event or two page views.
    """
    rows = sessionize(events, user, ts)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    facts = rows.groupBy(F.col(user).alias("_u"), F.col("session_no").alias("_s")).agg(
        ((F.max(micros) - F.min(micros)) / 1_000_000).alias("seconds"), F.count_if(F.col(kind) == "view").alias("views"), F.count_if(F.col(kind).isin(*KEY_EVENTS)).alias("keys"),
    )
    engaged = (F.col("seconds") > ENGAGED_SECONDS) | (F.col("keys") > 0) | (F.col("views") > 1)
    visit = F.struct(F.col("_s").alias("no"), "seconds", engaged.alias("engaged"), (F.col("_s") == 1).alias("first")).alias("visit")
    joined = rows.join(facts.select("_u", "_s", visit), F.col(user).eqNullSafe(F.col("_u")) & (F.col("session_no") == F.col("_s")))
    return joined.select(*events.columns, "visit")


@dataclass(frozen=True)
class PerVisit:
    """A metric over one row per visit of a group: columns ``user``, ``no``, ``seconds``, ``engaged``, ``first``."""

    user: str
    metric: Column


def visit_metrics(user: str = "user_id") -> dict[str, PerVisit]:
    """Session metrics over the rows of :func:`with_visits`; a session counts in every group it has an event in."""
    count, engaged = F.count(F.lit(1)), F.count_if("engaged")
    made = {
        # A user has one first visit, so counting those counts users.
        "sessions": count, "newUsers": F.count_if(F.col("first") & F.col("user").isNotNull()), "engagedSessions": engaged,
        "engagementRate": engaged / count, "bounceRate": 1 - engaged / count, "averageSessionDuration": F.sum("seconds") / count,
    }
    return {name: PerVisit(user, metric) for name, metric in made.items()}


def report(
    events: DataFrame,
    dims: Sequence[str],
    metrics: Sequence[str],
    known_dims: dict[str, Column],
    known_metrics: dict[str, Column | PerVisit],
    ts: str,
    start: object = None,
    end: object = None,
    dim_filter: Column | None = None,
    metric_filter: Column | None = None,
    property_id: str | Column = "default",
) -> DataFrame:
    """Metrics by dimensions over the days ``[start, end]``, by date first; both filters are optional.

    The dimension filter acts on event columns before the counting, the metric filter on the result.
    The key of the result is ``property_id`` and the dimensions.
    """
    bad = [d for d in dims if d not in known_dims] + [m for m in metrics if m not in known_metrics]
    if bad:
        raise SpecError(f"unknown dimensions or metrics: {bad}")
    if len(dims) > MAX_DIMENSIONS or len(metrics) > MAX_METRICS:
        raise SpecError(f"at most {MAX_DIMENSIONS} dimensions and {MAX_METRICS} metrics")
    rows = events
    if start is not None:
        rows = rows.filter(F.col(ts) >= bound(events, ts, start))
    if end is not None:
        rows = rows.filter(F.col(ts) < bound(events, ts, date.fromisoformat(str(end)) + timedelta(days=1)))
    if dim_filter is not None:
        rows = rows.filter(dim_filter)
    source = (property_id if isinstance(property_id, Column) else F.lit(property_id)).alias("property_id")
    group = [source, *[known_dims[d].alias(d) for d in dims]]
    visits = [known_metrics[m] for m in metrics if isinstance(known_metrics[m], PerVisit)]
    plain = [known_metrics[m].alias(m) for m in metrics if not isinstance(known_metrics[m], PerVisit)]
    out = rows.groupBy(*group).agg(*plain) if plain or not visits else None
    if visits:
        # Visits are made distinct first and counted then, so no group gathers them.
        named = lambda c: f"_by{c}"
        keys = [c.alias(named(i)) for i, c in enumerate([source, *[known_dims[d] for d in dims]])]
        each = rows.select(*keys, F.col(visits[0].user).alias("user"), "visit.*").distinct()
        names = ["property_id", *dims]
        counted = each.groupBy(*[named(i) for i in range(len(keys))]).agg(*[known_metrics[m].metric.alias(m) for m in metrics if isinstance(known_metrics[m], PerVisit)])
        counted = counted.select(*[F.col(named(i)).alias(n) for i, n in enumerate(names)], *[m for m in metrics if isinstance(known_metrics[m], PerVisit)])
        out = (counted if out is None else join_on(out, counted, names)).select(*names, *metrics)
    if metric_filter is not None:
        out = out.filter(metric_filter)
    return out.orderBy("date") if "date" in dims else out


def preset(name: str, **override) -> dict:
    """Options of a named report; given options win."""
    if name not in PRESETS:
        raise SpecError(f"unknown report {name}")
    return {**PRESETS[name], **override}


def start_of(text: str, today: object) -> str:
    """``30daysAgo``, ``yesterday`` or ``today`` as a date; a date stays as it is."""
    day = date.fromisoformat(str(today))
    if text.endswith("daysAgo"):
        return str(day - timedelta(days=int(text.removesuffix("daysAgo"))))
    return str(day - timedelta(days=1)) if text == "yesterday" else str(day) if text == "today" else text


def run_preset(events: DataFrame, name: str, known_dims: dict[str, Column], known_metrics: dict[str, Column], ts: str, today: object, last_date: object = None, **override) -> DataFrame:
    """A named report over its own range: from ``start_date``, or after a first run from ``lookback_days`` before the last day read."""
    options = preset(name, **override)
    start = start_of(options["start_date"], today) if last_date is None else reread_from(last_date, int(options["lookback_days"]))
    return report(events, options["dimensions"], options["metrics"], known_dims, known_metrics, ts, start, today)


def reread_from(last_date: object, lookback_days: int = LOOKBACK_DAYS) -> str:
    """First day of an incremental read: late events change the last days, so these are read again."""
    return str(date.fromisoformat(str(last_date)) - timedelta(days=lookback_days))


def report_multi(events: DataFrame, source: str, **args) -> DataFrame:
    """The same report for every source in one pass: the source is one more group key."""
    return report(events, property_id=F.col(source).cast("string"), **args)

"""Queries over joins, aggregates, reports, sessions and time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators import aggregates as ag, joins as jo, reports as rp, sessions as se, timeseries as ts
from weirflow.plans.registry import query, table

# --- joins ---------------------------------------------------------------------------------


@query("joi_1_fan_out_children", """
    SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def _(spark, sf):
    parents = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    rows = jo.fan_out_children(parents, table(spark, sf, "lineitem"), ["l_orderkey"], ["o_custkey", "o_orderstatus"])
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "o_custkey", "o_orderstatus")


@query("joi_2_left_enrich", """
    SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def _(spark, sf):
    cust = table(spark, sf, "customer").filter("c_acctbal >= 0")
    rows = jo.left_enrich(table(spark, sf, "orders"), cust, F.col("o_custkey") == F.col("c_custkey"), ["c_name", "c_nationkey"])
    rows = jo.left_enrich(rows, table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), ["n_name"])
    return rows.select("o_orderkey", "c_name", "n_name")


@query("joi_3_inner_count", """
    SELECT o_orderkey, count(*) AS reply_count, CAST(max(l_shipdate) AS VARCHAR) AS latest_reply FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def _(spark, sf):
    got = jo.reply_counts(table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", "l_shipdate")
    return got.select("o_orderkey", "reply_count", F.col("latest_reply").cast("string").alias("latest_reply"))


@query("joi_4_semi_changed", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-01')")
def _(spark, sf):
    changed = table(spark, sf, "orders").filter("o_orderdate > timestamp_ntz'2000-06-01'").select(F.col("o_custkey").alias("c_custkey"))
    return jo.fetch_by_ids(table(spark, sf, "customer"), changed, "c_custkey").select("c_custkey", "c_name")


@query("joi_5_metadata_attach", "SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, sf):
    got = jo.metadata_attach(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id", "quality")
    return got.select("doc_id", "lang", "quality")


@query("joi_6_inherit_parent", """
    SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'N' THEN o_orderdate ELSE l_shipdate END AS VARCHAR) AS day, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def _(spark, sf):
    kids = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("day"))
    ups = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("day"), "o_custkey")
    got = jo.inherit_parent(kids, ups, "l_orderkey", ["day", "o_custkey"])
    return got.select("l_orderkey", "l_linenumber", F.col("day").cast("string").alias("day"), "o_custkey")


@query("joi_7_asof_value", """
    SELECT p.event_id, p.user_id, v.value, CAST(v.ts AS VARCHAR) AS value_at
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    points = ev.filter("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("at"))
    values = ev.filter("event_type = 'view'").select("user_id", "ts", "value")
    got = jo.asof_value(points, values, ["user_id"], "at", "ts", "value")
    return got.select("event_id", "user_id", "value", F.col("value_at").cast("string").alias("value_at"))


@query("joi_7_value_at", """
    SELECT user_id, arg_max(value, ts) AS value FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY user_id
""")
def _(spark, sf):
    return jo.value_at(table(spark, sf, "events"), ["user_id"], "ts", "value", "2024-01-15 12:00:00").select("user_id", "value")


FRAMES = """
    SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate AS s, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_shipdate + to_days(l_linenumber * 9) END AS e FROM lineitem
"""


def _frames(spark, sf):
    until = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_linenumber") * 9))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").alias("s"), until.alias("e"))


@query("joi_8_interval_overlap", f"""
    SELECT l_orderkey, l_linenumber FROM ({FRAMES}) WHERE s <= TIMESTAMP '1997-02-01' AND (e IS NULL OR e >= TIMESTAMP '1997-01-01')
""")
def _(spark, sf):
    return jo.overlapping(_frames(spark, sf), "s", "e", "1997-01-01", "1997-02-01").select("l_orderkey", "l_linenumber")


@query("joi_8_overlap_pairs", f"""
    WITH spans AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS a, date_trunc('month', o_orderdate) + INTERVAL 5 DAY AS b FROM orders)
    SELECT CAST(a AS VARCHAR) AS span_start, count(*) AS frames, sum(l_quantity) AS quantity FROM ({FRAMES}) f JOIN spans ON s <= b AND (e IS NULL OR e >= a) GROUP BY a
""")
def _(spark, sf):
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    spans = table(spark, sf, "orders").select(month.alias("a")).distinct().withColumn("b", F.col("a") + F.make_dt_interval(days=F.lit(5)))
    pairs = jo.overlap_pairs(_frames(spark, sf), spans, ("s", "e"), ("a", "b"), 30 * 86400)
    out = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("frames"), F.sum("l_quantity").alias("quantity"))
    return out.select(F.col("a").cast("string").alias("span_start"), "frames", "quantity")


@query("joi_9_primary_or_referenced", """
    SELECT o_orderkey AS frame, o_custkey AS element, 'primary' AS relationship_type FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT l_orderkey, l_suppkey, 'referenced' FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' OR l_suppkey <> o_custkey
""")
def _(spark, sf):
    frames = table(spark, sf, "orders").select(F.col("o_orderkey").alias("frame"), F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("main"))
    links = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("frame"), F.col("l_suppkey").alias("element"))
    return jo.primary_or_referenced(frames, links, "frame", "main", "element")


@query("joi_10_tombstone_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, sf):
    gone = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return jo.tombstone_anti(table(spark, sf, "customer"), gone, ["c_custkey"]).select("c_custkey")


@query("joi_11_ids_present", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O'")
def _(spark, sf):
    item = table(spark, sf, "lineitem")
    missing = jo.ids_missing(item.filter("l_returnflag = 'R'"), item.filter("l_linestatus = 'O'"), ["l_orderkey", "l_linenumber"])
    return missing.distinct()


@query("joi_12_fetch_by_ids", "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)")
def _(spark, sf):
    ids = table(spark, sf, "lineitem").filter("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey"))
    return jo.fetch_by_ids(table(spark, sf, "part"), ids, "p_partkey").select("p_partkey", "p_name")


@query("joi_13_resolve_pairs", """
    SELECT c.c_nationkey AS team, c.c_mktsegment AS channel, c_custkey AS message_id FROM customer c
    JOIN (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9000) p ON c.c_nationkey = p.c_nationkey AND c.c_mktsegment = p.c_mktsegment
""")
def _(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("team"), F.col("c_mktsegment").alias("channel"), F.col("c_custkey").alias("message_id"), "c_acctbal")
    pairs = rows.filter("c_acctbal > 9000").select("team", "channel").distinct()
    return jo.resolve_pairs(pairs, rows, ["team", "channel"], "message_id")


# --- reports -------------------------------------------------------------------------------


def _dims():
    return {
        "date": F.to_date("ts"), "eventName": F.col("event_type"), "hour": F.hour("ts"),
        "itemId": F.get_json_object("props", "$.k"),
    }


def _report(ev, dims, metrics, **kw):
    return rp.report(ev, dims, metrics, _dims(), rp.event_metrics(), "ts", **kw)


@query("agg_1_report", """
    SELECT 'default' AS property_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS "eventName", count(DISTINCT user_id) AS "activeUsers", count(*) AS "eventCount",
           round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS "totalRevenue"
    FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-26' AND event_type <> 'error'
    GROUP BY CAST(ts AS DATE), event_type HAVING count(DISTINCT user_id) > 1
""")
def _(spark, sf):
    got = _report(table(spark, sf, "events"), ["date", "eventName"], ["activeUsers", "eventCount", "totalRevenue"], start="2024-01-05", end="2024-01-25",
                  dim_filter=F.col("event_type") != "error", metric_filter=F.col("activeUsers") > 1)
    return got.withColumns({"date": F.col("date").cast("string"), "totalRevenue": F.round("totalRevenue", 2)})


@query("agg_1_report_incremental", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS "eventCount" FROM events GROUP BY CAST(ts AS DATE)
""")
def _(spark, sf):
    from weirflow.operators.changes import scd1, visible

    ev = table(spark, sf, "events")
    # The first read saw only part of the last days; the second one reads them again and replaces them by key.
    early = ev.filter("ts < timestamp_ntz'2024-01-20' AND NOT (ts >= timestamp_ntz'2024-01-18' AND event_type = 'view')")
    first = _report(early, ["date"], ["eventCount"]).withColumn("run", F.lit(1))
    second = _report(ev, ["date"], ["eventCount"], start=rp.reread_from("2024-01-19")).withColumn("run", F.lit(2))
    state = visible(scd1(first, second, ["property_id", "date"], ["run"]))
    return state.select(F.col("date").cast("string").alias("date"), "eventCount")


@query("agg_2_prebuilt_report", """
    SELECT 'default' AS property_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS "eventName", count(*) AS "eventCount", count(DISTINCT user_id) AS "activeUsers"
    FROM events GROUP BY CAST(ts AS DATE), event_type
""")
def _(spark, sf):
    args = rp.preset("events_summary")
    return _report(table(spark, sf, "events"), args["dimensions"], args["metrics"]).withColumn("date", F.col("date").cast("string"))


def _preset(spark, sf, name, **options):
    ev = rp.with_visits(table(spark, sf, "events"))
    dims = _dims() | {"newVsReturning": F.when(F.col("visit.first"), "new").otherwise("returning"), "pagePath": F.concat(F.lit("/"), F.col("event_type")), "pageTitle": F.col("event_type")}
    got = rp.run_preset(ev, name, dims, rp.event_metrics() | rp.visit_metrics(), "ts", "2024-01-28", **options)
    return got.withColumn("date", F.col("date").cast("string"))


VISITS = """
    WITH e AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 1800000000 THEN 0 ELSE 1 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    n AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM e),
    f AS (SELECT user_id, no, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 AS seconds, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type IN ('purchase', 'signup')) AS keys FROM n GROUP BY ALL),
    v AS (SELECT n.*, seconds, (seconds > 10 OR views > 1 OR keys > 0) AS engaged FROM n JOIN f USING (user_id, no) WHERE ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '2024-01-29')
"""


@query("agg_2_preset_user_retention", VISITS.format(start="2023-12-29") + """
    SELECT 'default' AS property_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CASE WHEN no = 1 THEN 'new' ELSE 'returning' END AS "newVsReturning", count(DISTINCT user_id) AS "activeUsers",
           count(DISTINCT (user_id, no)) AS sessions, round(count(DISTINCT CASE WHEN engaged THEN (user_id, no) END) / count(DISTINCT (user_id, no)), 9) AS "engagementRate"
    FROM v GROUP BY ALL
""")
def _(spark, sf):
    return _preset(spark, sf, "user_retention").withColumn("engagementRate", F.round("engagementRate", 9))


@query("agg_2_preset_page_performance", VISITS.format(start="2024-01-17") + """
    , d AS (SELECT CAST(ts AS DATE) AS day, event_type, user_id, no, any_value(seconds) AS seconds, any_value(engaged) AS engaged, count(*) FILTER (event_type = 'view') AS views FROM v GROUP BY ALL)
    SELECT 'default' AS property_id, CAST(day AS VARCHAR) AS date, '/' || event_type AS "pagePath", event_type AS "pageTitle", CAST(sum(views) AS BIGINT) AS "screenPageViews",
           round(sum(seconds) / count(*), 5) AS "averageSessionDuration", round(1 - count(*) FILTER (engaged) / count(*), 9) AS "bounceRate"
    FROM d GROUP BY ALL
""")
def _(spark, sf):
    got = _preset(spark, sf, "page_performance", last_date="2024-01-20")
    return got.withColumns({"averageSessionDuration": F.round("averageSessionDuration", 5), "bounceRate": F.round("bounceRate", 9)})


@query("agg_2_preset_purchase_journey", """
    SELECT 'default' AS property_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS "eventName", count(DISTINCT user_id) AS "activeUsers", count(*) AS "eventCount"
    FROM events WHERE ts >= TIMESTAMP '2023-12-29' AND ts < TIMESTAMP '2024-01-29' GROUP BY ALL
""")
def _(spark, sf):
    return _preset(spark, sf, "purchase_journey")


@query("agg_2_preset_checkout_journey", """
    SELECT 'default' AS property_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS "eventName", count(DISTINCT user_id) AS "activeUsers", count(*) AS "eventCount"
    FROM events WHERE ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-29' GROUP BY ALL
""")
def _(spark, sf):
    return _preset(spark, sf, "checkout_journey", start_date="6daysAgo")


@query("agg_3_union_sources", """
    SELECT CAST(user_id % 3 AS VARCHAR) AS property_id, event_type AS "eventName", count(*) AS "eventCount" FROM events GROUP BY user_id % 3, event_type
""")
def _(spark, sf):
    ev = table(spark, sf, "events").withColumn("property", F.col("user_id") % 3)
    return rp.report_multi(ev, "property", dims=["eventName"], metrics=["eventCount"], known_dims=_dims(), known_metrics=rp.event_metrics(), ts="ts")


@query("flt_7_dim_metric_filter", """
    SELECT event_type AS "eventName", count(*) FILTER (event_type IN ('purchase', 'signup')) AS "keyEvents" FROM events WHERE value > 50 GROUP BY event_type HAVING count(*) FILTER (event_type IN ('purchase', 'signup')) > 0
""")
def _(spark, sf):
    got = _report(table(spark, sf, "events"), ["eventName"], ["keyEvents"], dim_filter=F.col("value") > 50, metric_filter=F.col("keyEvents") > 0)
    return got.select("eventName", "keyEvents")


# --- sessions ------------------------------------------------------------------------------

SESSIONS = """
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 5 HOUR THEN 0 ELSE 1 END AS opens FROM events),
    n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM g),
    s AS (SELECT user_id, session_no, min(ts) AS a, max(ts) AS b, count(*) AS events FROM n GROUP BY user_id, session_no)
"""
FIVE_HOURS = 5 * 3600


@query("win_2_sessionize", f"{SESSIONS} SELECT event_id, user_id, CAST(session_no AS BIGINT) AS session_no FROM n")
def _(spark, sf):
    return se.sessionize(table(spark, sf, "events"), gap_seconds=FIVE_HOURS).select("event_id", "user_id", "session_no")


@query("win_2_sessions", f"""
    {SESSIONS} SELECT user_id, CAST(session_no AS BIGINT) AS session_no, events, round((epoch_us(b) - epoch_us(a)) / 1000000.0, 6) AS seconds FROM s
""")
def _(spark, sf):
    got = se.sessions(table(spark, sf, "events"), gap_seconds=FIVE_HOURS)
    return got.select("user_id", "session_no", "events", F.round("seconds", 6).alias("seconds"))


@query("agg_4_active_users", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS segment, count(DISTINCT user_id) AS count FROM events GROUP BY CAST(ts AS DATE), event_type
""")
def _(spark, sf):
    return se.active_users(table(spark, sf, "events"), segment=F.col("event_type")).withColumn("date", F.col("date").cast("string"))


@query("agg_4_new_users_weekly", """
    SELECT CAST(CAST(date_trunc('week', first) AS DATE) AS VARCHAR) AS date, 'Totals' AS segment, count(*) AS count
    FROM (SELECT user_id, min(ts) AS first FROM events GROUP BY user_id) GROUP BY 1
""")
def _(spark, sf):
    return se.active_users(table(spark, sf, "events"), "new", 7).withColumn("date", F.col("date").cast("string"))


@query("agg_5_session_avg_length", f"""
    {SESSIONS} SELECT CAST(CAST(a AS DATE) AS VARCHAR) AS date, round(avg((epoch_us(b) - epoch_us(a)) / 1000000.0), 3) AS length FROM s GROUP BY CAST(a AS DATE)
""")
def _(spark, sf):
    got = se.session_avg_length(table(spark, sf, "events"), FIVE_HOURS)
    return got.select(F.col("date").cast("string").alias("date"), F.round("length", 3).alias("length"))


@query("agg_6_session_length_histogram", f"""
    {SESSIONS} SELECT CASE WHEN x < 60 THEN '0-60' WHEN x < 3600 THEN '60-3600' WHEN x < 14400 THEN '3600-14400' ELSE '14400+' END AS bucket, count(*) AS count
    FROM (SELECT (epoch_us(b) - epoch_us(a)) / 1000000.0 AS x FROM s) GROUP BY 1
""")
def _(spark, sf):
    return se.session_histogram(table(spark, sf, "events"), [0, 60, 3600, 14400], FIVE_HOURS)


@query("agg_7_sessions_per_user", f"""
    {SESSIONS} SELECT CAST(d AS VARCHAR) AS date, round(avg(n), 6) AS avg_sessions FROM (SELECT CAST(a AS DATE) AS d, user_id, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY d
""")
def _(spark, sf):
    got = se.sessions_per_user(table(spark, sf, "events"), FIVE_HOURS)
    return got.select(F.col("date").cast("string").alias("date"), F.round("avg_sessions", 6).alias("avg_sessions"))


@query("agg_8_cohort_members", """
    SELECT cohort, count(*) AS members FROM (
        SELECT 'rich' AS cohort, c_custkey FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT 'builders', c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY cohort
""")
def _(spark, sf):
    rules = {"rich": F.col("c_acctbal") > 5000, "builders": F.col("c_mktsegment") == "BUILDING", "none": F.col("c_custkey") < 0}
    members = se.cohort_members(table(spark, sf, "customer"), rules, "c_custkey")
    return members.groupBy("cohort").agg(F.count(F.lit(1)).alias("members"))


@query("agg_9_survey_rollup", """
    SELECT lang_key AS survey, question, choice, count(*) AS responses FROM (
        SELECT source AS lang_key, 'lang' AS question, lang AS choice FROM documents UNION ALL
        SELECT source, 'size', CASE WHEN n_chars > 1000 THEN 'long' ELSE 'short' END FROM documents) GROUP BY 1, 2, 3
""")
def _(spark, sf):
    size = F.when(F.col("n_chars") > 1000, F.lit("long")).otherwise(F.lit("short"))
    rows = table(spark, sf, "documents").select(F.col("source").alias("survey"), F.create_map(F.lit("lang"), F.col("lang"), F.lit("size"), size).alias("answers"))
    return se.survey_rollup(rows, "answers", "survey")


# --- time series ---------------------------------------------------------------------------

HELD = """
    WITH h AS (SELECT event_type AS tag, value AS v, greatest(ts, TIMESTAMP '2024-01-03') AS a,
        least(coalesce(lead(ts) OVER (PARTITION BY event_type ORDER BY ts), TIMESTAMP '2024-01-27'), TIMESTAMP '2024-01-27') AS b FROM events),
    d AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-26', INTERVAL 1 DAY)) AS d0),
    p AS (SELECT tag, v, d0, (epoch_us(least(b, d0 + INTERVAL 1 DAY)) - epoch_us(greatest(a, d0))) / 1000000.0 AS w
          FROM h JOIN d ON a < d0 + INTERVAL 1 DAY AND b > d0 WHERE a < b)
"""


@query("agg_10_ts_summary", f"""
    {HELD}, s AS (SELECT tag, d0, sum(v * w) / 86400 AS "Total", sum(v * w) / sum(w) AS "Average", min(v) AS "Minimum", max(v) - min(v) AS "Range", sum(w) AS "Count" FROM p GROUP BY tag, d0)
    SELECT tag, summary_type, CAST(d0 AS VARCHAR) AS at, round(value, 4) AS value FROM (UNPIVOT s ON "Total", "Average", "Minimum", "Range", "Count" INTO NAME summary_type VALUE value)
""")
def _(spark, sf):
    got = ts.ts_summary(table(spark, sf, "events"), "event_type", "ts", "value", "2024-01-03", "2024-01-27", ["Total", "Average", "Minimum", "Range", "Count"], 86400)
    return got.select(F.col("event_type").alias("tag"), "summary_type", F.col("timestamp").cast("string").alias("at"), F.round("value", 4).alias("value"))


@query("agg_10_ts_summary_events", """
    WITH s AS (SELECT event_type AS tag, sum(value) AS "Total", avg(value) AS "Average", CAST(count(*) AS DOUBLE) AS "Count", stddev_samp(value) AS "StdDev", max(value) AS "Maximum"
               FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-27' GROUP BY event_type)
    SELECT tag, summary_type, round(value, 4) AS value FROM (UNPIVOT s ON "Total", "Average", "Count", "StdDev", "Maximum" INTO NAME summary_type VALUE value)
""")
def _(spark, sf):
    got = ts.ts_summary(table(spark, sf, "events"), "event_type", "ts", "value", "2024-01-03", "2024-01-27", ["Total", "Average", "Count", "StdDev", "Maximum"], None, "EventWeighted")
    return got.select(F.col("event_type").alias("tag"), "summary_type", F.round("value", 4).alias("value"))


@query("agg_11_ts_calculated", f"{HELD} SELECT tag, CAST(d0 AS VARCHAR) AS at, round(sum(v * w) / sum(w), 4) AS value FROM p GROUP BY tag, d0")
def _(spark, sf):
    got = ts.ts_calculated(table(spark, sf, "events"), "event_type", "ts", "value", "2024-01-03", "2024-01-27", "Average", 86400)
    return got.select(F.col("event_type").alias("tag"), F.col("timestamp").cast("string").alias("at"), F.round("value", 4).alias("value"))


@query("agg_12_ts_plot", """
    WITH b AS (SELECT event_type AS tag, ts, value, least(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 64800000000), 39) AS slot
               FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts <= TIMESTAMP '2024-01-31'),
    r AS (SELECT *, row_number() OVER (PARTITION BY tag, slot ORDER BY ts) AS f, row_number() OVER (PARTITION BY tag, slot ORDER BY ts DESC) AS l,
              row_number() OVER (PARTITION BY tag, slot ORDER BY value, ts) AS lo, row_number() OVER (PARTITION BY tag, slot ORDER BY value DESC, ts) AS hi FROM b)
    SELECT tag, CAST(ts AS VARCHAR) AS at, value FROM r WHERE f = 1 OR l = 1 OR lo = 1 OR hi = 1
""")
def _(spark, sf):
    got = ts.ts_plot(table(spark, sf, "events"), "event_type", "ts", "value", "2024-01-01", "2024-01-31", 40)
    return got.select(F.col("event_type").alias("tag"), F.col("ts").cast("string").alias("at"), "value")


@query("win_5_ts_interpolate", """
    WITH g AS (SELECT event_type AS tag, t FROM (SELECT DISTINCT event_type FROM events), (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-01-31', INTERVAL 30 MINUTE)) AS t)),
    a AS (SELECT g.tag, g.t, e.ts AS t0, e.value AS v0 FROM g ASOF LEFT JOIN events e ON g.tag = e.event_type AND g.t >= e.ts),
    b AS (SELECT a.*, e.ts AS t1, e.value AS v1 FROM a ASOF LEFT JOIN events e ON a.tag = e.event_type AND a.t <= e.ts)
    SELECT tag, CAST(t AS VARCHAR) AS at, round(CASE WHEN t0 = t THEN v0 ELSE v0 + (v1 - v0) * (epoch_us(t) - epoch_us(t0)) / (epoch_us(t1) - epoch_us(t0)) END, 4) AS value FROM b
""")
def _(spark, sf):
    got = ts.ts_interpolate(table(spark, sf, "events"), "event_type", "ts", "value", "2023-12-31", "2024-01-31", 1800)
    return got.select(F.col("event_type").alias("tag"), F.col("ts").cast("string").alias("at"), F.round("value", 4).alias("value"))


@query("win_6_ts_recorded", """
    SELECT event_type AS tag, CAST(ts AS VARCHAR) AS at, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, event_type <> 'view' AS good, false AS questionable, '' AS units
    FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25' AND event_type <> 'signup'
""")
def _(spark, sf):
    kind = F.col("event_type")
    raw = table(spark, sf, "events").select(
        kind.alias("tag"), F.when(kind != "signup", F.col("ts")).alias("timestamp"),
        F.when(kind == "error", F.lit("Bad Input")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(kind == "view", F.lit("No")).alias("good"),
    )
    got = ts.ts_recorded(raw, "2024-01-05", "2024-01-25")
    return got.select("tag", F.col("timestamp").cast("string").alias("at"), "value", "good", "questionable", "units")


@query("win_7_ts_current", "SELECT user_id, arg_max(value, ts) AS value, CAST(max(ts) AS VARCHAR) AS at FROM events GROUP BY user_id")
def _(spark, sf):
    got = ts.ts_current(table(spark, sf, "events").select("user_id", "ts", "value"), "user_id", "ts")
    return got.select("user_id", "value", F.col("ts").cast("string").alias("at"))


@query("win_1_version_bounds", """
    SELECT o_custkey, CAST(o_orderdate AS VARCHAR) AS start_at, CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS VARCHAR) AS end_at, o_orderkey FROM orders
""")
def _(spark, sf):
    from weirflow.operators.ordered import with_neighbour

    rows = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    got = with_neighbour(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"nxt": F.col("o_orderdate")})
    return got.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("string").alias("start_at"), F.col("nxt").cast("string").alias("end_at"))


# --- counts and duplicates -----------------------------------------------------------------


@query("agg_13_type_catalog", """
    SELECT CASE WHEN p_size < 5 THEN 'Unknown' ELSE split_part(p_name, ' ', 1) END AS point_type, p_type AS engineering_units, count(*) AS count_points FROM part GROUP BY 1, 2
""")
def _(spark, sf):
    rows = table(spark, sf, "part").select(F.when(F.col("p_size") >= 5, F.col("p_name")).alias("descriptor"), F.concat(F.lit(" "), "p_type").alias("units"))
    return ag.type_catalog(rows, "descriptor", "units")


@query("agg_14_table_counts", """
    SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'documents', count(*) FROM documents
""")
def _(spark, sf):
    return ag.table_counts({t: table(spark, sf, t) for t in ("orders", "lineitem", "documents")})


@query("agg_15_group_min_max_count", """
    SELECT n_name AS team, c_mktsegment AS channel, count(*) AS message_count, CAST(max(o_orderdate) AS VARCHAR) AS latest_message, CAST(min(o_orderdate) AS VARCHAR) AS oldest_message
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
""")
def _(spark, sf):
    per = ag.group_span(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "o_orderdate")
    named = jo.left_enrich(per, table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), ["c_nationkey", "c_mktsegment"])
    named = jo.left_enrich(named, table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), ["n_name"])
    out = ag.merge_span(named.select(F.col("n_name").alias("team"), F.col("c_mktsegment").alias("channel"), "message_count", "latest_message", "oldest_message"), ["team", "channel"])
    return out.withColumns({c: F.col(c).cast("string") for c in ("latest_message", "oldest_message")})


@query("lim_2_top_groups", """
    SELECT o_orderkey, reply_count FROM (
        SELECT l_orderkey AS o_orderkey, count(*) AS reply_count, max(l_shipdate) AS latest FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey)
    ORDER BY reply_count DESC, latest DESC, o_orderkey LIMIT 10
""")
def _(spark, sf):
    got = jo.reply_counts(table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", "l_shipdate")
    return ag.top_groups(got, "reply_count", "latest_reply", 10, ["o_orderkey"]).select("o_orderkey", "reply_count")


@query("agg_16_max_cursor", "SELECT CAST(max(CASE WHEN event_type <> 'error' THEN ts END) AS VARCHAR) AS cursor FROM events")
def _(spark, sf):
    from weirflow.functions.scalars import normalize_iso

    raw = F.when(F.col("event_type") == "error", F.lit("9999")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    got = ag.max_cursor(table(spark, sf, "events").select(raw.alias("t")), normalize_iso(F.col("t")))
    return got.select(F.col("cursor").cast("string").alias("cursor"))


@query("agg_17_dedupe_full_row", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(spark, sf):
    return ag.dedupe_full_row(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("agg_17_dedupe_maps", "SELECT event_type, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events GROUP BY 1, 2")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_type", F.from_json("props", "map<string,string>").alias("m"))
    return ag.dedupe_full_row(rows).select("event_type", F.col("m")["k"].alias("k"))


@query("agg_18_dedupe_by_best_key", """
    SELECT min(event_id) AS event_id FROM (
        SELECT *, CASE event_type WHEN 'click' THEN 'id=' || user_id WHEN 'view' THEN 'name=' || props ELSE 'row' || event_id END AS k FROM events) GROUP BY k
""")
def _(spark, sf):
    kind = F.col("event_type")
    rows = table(spark, sf, "events").select("event_id", F.when(kind == "click", F.col("user_id")).alias("id"), F.when(kind == "view", F.col("props")).alias("name"))
    return ag.dedupe_by_best_key(rows, ["event_id"]).select("event_id")

"""Queries over the incremental readers, feeds and file scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions.scalars import valid_uid
from weirflow.operators.ordered import with_position
from weirflow.plans.registry import query, table
from weirflow.session import fresh_path
from weirflow.sources import feeds, files, incremental as inc

EVENT_COLS = ["event_id", "user_id", "event_type", "value"]


@query("src_1_snapshot_scan", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def _(spark, sf):
    return inc.snapshot_scan(spark, f"{sf}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_retailprice")


@query("src_1_snapshot_filter", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(spark, sf):
    return inc.snapshot_scan(spark, f"{sf}/customer.parquet", filters={"c_mktsegment": "BUILDING"}).select("c_custkey", "c_name")


@query("src_2_cursor_scan", """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE ts > TIMESTAMP '2024-01-08 00:00:00' AND ts <= TIMESTAMP '2024-01-22 12:00:00' AND event_type = 'click'
""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    return inc.cursor_scan(ev, "ts", "2024-01-08 00:00:00", "2024-01-22 12:00:00", {"event_type": "click"}).select(*EVENT_COLS)


@query("src_3_admit_batch", """
    WITH cut AS (SELECT max(o_orderdate) AS c FROM (SELECT o_orderdate FROM orders ORDER BY o_orderdate LIMIT 500))
    SELECT o_orderkey, o_totalprice FROM orders, cut WHERE o_orderdate <= c
""")
def _(spark, sf):
    rows, _ = inc.admit_batch(table(spark, sf, "orders"), "o_orderdate", 500)
    return rows.select("o_orderkey", "o_totalprice")


@query("src_4_keyset_scan", """
    SELECT o_orderkey, o_custkey FROM (
        SELECT * FROM orders
        WHERE (o_orderdate > TIMESTAMP '1995-06-01' OR (o_orderdate = TIMESTAMP '1995-06-01' AND o_orderkey > 100))
          AND o_orderdate <= TIMESTAMP '1998-01-01'
        ORDER BY o_orderdate, o_orderkey LIMIT 700)
""")
def _(spark, sf):
    start = {"cursor": "1995-06-01 00:00:00", "tiebreak": "100"}
    rows, _ = inc.keyset_scan(table(spark, sf, "orders"), "o_orderdate", "o_orderkey", start, 700, "1998-01-01 00:00:00")
    return rows.select("o_orderkey", "o_custkey")


@query("src_3_admit_batch_without_cursors", """
    WITH dated AS (SELECT * FROM events WHERE event_type <> 'error'),
    one AS (SELECT max(ts) AS c FROM (SELECT ts FROM dated ORDER BY ts LIMIT 40)),
    two AS (SELECT max(ts) AS c FROM (SELECT ts FROM dated, one WHERE ts > c ORDER BY ts LIMIT 40))
    SELECT event_id, CASE WHEN ts <= one.c THEN 1 ELSE 2 END AS batch FROM dated, one, two WHERE ts <= two.c
""")
def _(spark, sf):
    ev = table(spark, sf, "events").withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    first, offset = inc.admit_batch(ev, "ts", 40)
    second, _ = inc.admit_batch(ev, "ts", 40, offset["cursor"])
    nothing, end = inc.admit_batch(ev.filter("ts IS NULL"), "ts", 40)
    assert not end
    parts = [d.select("event_id", F.lit(i).alias("batch")) for i, d in ((1, first), (2, second), (3, nothing))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("src_4_keyset_offset_text", """
    SELECT o_orderkey, o_custkey FROM (
        SELECT * FROM orders WHERE (o_orderdate > TIMESTAMP '1995-06-01' OR (o_orderdate = TIMESTAMP '1995-06-01' AND o_orderkey > 100)) AND o_orderdate <= TIMESTAMP '1998-01-01'
        ORDER BY o_orderdate, o_orderkey LIMIT 700)
""")
def _(spark, sf):
    # The same moments, written with three offsets.
    hours = F.element_at(F.array(F.lit(0), F.lit(5), F.lit(-7)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    zone = F.element_at(F.array(F.lit("Z"), F.lit("+05:00"), F.lit("-07:00")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    local = F.date_format(F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(hours=hours), "yyyy-MM-dd'T'HH:mm:ss")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.concat(local, zone).alias("at"))
    start = {"cursor": "1995-06-01T03:00:00+03:00", "tiebreak": "100"}
    return inc.keyset_scan(orders, "at", "o_orderkey", start, 700, "1997-12-31T16:00:00-08:00")[0].select("o_orderkey", "o_custkey")


@query("src_5_window_scan", """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'
""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    rows, _ = inc.window_scan(ev, "ts", {"cursor": "2024-01-05 00:00:00"}, 7 * 86400, "2024-02-01 00:00:00")
    return rows.select(*EVENT_COLS)


@query("src_6_multi_window_scan", """
    WITH seen AS (
        SELECT *, CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-03') - 1) / 21600000000) AS BIGINT) AS win
        FROM events WHERE ts > TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-28'),
    counts AS (SELECT win, count(*) AS n FROM seen GROUP BY win),
    run AS (SELECT win, sum(n) OVER (ORDER BY win) AS total FROM counts),
    stop AS (SELECT min(win) AS w FROM run WHERE total >= 900)
    SELECT event_id, user_id, event_type, value FROM seen, stop WHERE w IS NULL OR win <= w
""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    rows, _ = inc.multi_window_scan(ev, "ts", {"cursor": "2024-01-03 00:00:00"}, 21600, "2024-01-28 00:00:00", 900)
    return rows.select(*EVENT_COLS)


@query("src_7_hourly_window_scan", """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND ts < TIMESTAMP '2024-01-24 08:00:00'
""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    rows, _ = inc.hourly_window_scan(ev, "ts", {"hour": "2024-01-20 00:00:00"}, 240, 2, "2024-01-24 09:40:00")
    return rows.select(*EVENT_COLS)


@query("src_8_day_window_scan", """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-02-27' AND o_orderdate < TIMESTAMP '1996-05-30'
""")
def _(spark, sf):
    rows, _ = inc.day_window_scan(table(spark, sf, "orders"), "o_orderdate", {"day": "1996-03-01"}, 90, 3, "1999-12-31")
    return rows.select("o_orderkey", "o_orderstatus")


@query("src_9_lookback", """
    SELECT event_id, user_id, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-24 23:55:00'
""")
def _(spark, sf):
    since = inc.lookback("2024-01-25 00:00:00", seconds=300)
    return inc.cursor_scan(table(spark, sf, "events"), "ts", since).select(*EVENT_COLS)


@query("src_10_next_offset", """
    SELECT CAST(greatest(least(max(ts), TIMESTAMP '2024-01-29 00:00:00'), TIMESTAMP '2024-01-02 00:00:00') AS VARCHAR) AS next_cursor
    FROM events
""")
def _(spark, sf):
    at = inc.next_offset(table(spark, sf, "events"), "ts", "2024-01-02 00:00:00", "2024-01-29 00:00:00")
    return at.select(F.col("cursor").cast("string").alias("next_cursor"))


@query("src_11_exclusive_boundary", """
    SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31'
""")
def _(spark, sf):
    served = table(spark, sf, "orders").filter("o_orderdate >= timestamp_ntz'1997-01-01' AND o_orderdate <= timestamp_ntz'1998-06-30'")
    return inc.cursor_scan(served, "o_orderdate", "1997-01-01", "1997-12-31").select("o_orderkey")


MARKS = """
    SELECT event_type, max(ts) AS watermark FROM events
    WHERE event_type <> 'signup' AND ts < TIMESTAMP '2024-01-16' GROUP BY event_type
"""


def _marks(ev):
    early = ev.filter("event_type <> 'signup' AND ts < timestamp_ntz'2024-01-16'")
    return early.groupBy("event_type").agg(F.max("ts").alias("watermark"))


@query("src_12_keyed_watermarks_rows", f"""
    SELECT event_id, user_id, e.event_type, value FROM events e LEFT JOIN ({MARKS}) m ON e.event_type = m.event_type
    WHERE m.watermark IS NULL OR ts > m.watermark
""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    return inc.keyed_watermarks(ev, ["event_type"], "ts", _marks(ev))[0].select(*EVENT_COLS)


@query("src_12_keyed_watermarks_state", "SELECT event_type, CAST(max(ts) AS VARCHAR) AS watermark FROM events GROUP BY event_type")
def _(spark, sf):
    ev = table(spark, sf, "events")
    state = inc.keyed_watermarks(ev, ["event_type"], "ts", _marks(ev))[1]
    return state.select("event_type", F.col("watermark").cast("string").alias("watermark"))


@query("src_13_changed_parents", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_shipdate > TIMESTAMP '1997-06-01' AND l_shipdate <= TIMESTAMP '2001-01-01'
      AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01')
""")
def _(spark, sf):
    parents = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    rows = inc.changed_parents(parents, table(spark, sf, "lineitem"), "l_orderkey", "o_orderdate", "l_shipdate", "1997-06-01", "2001-01-01")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


def _as_files(spark, sf, name):
    """The documents written as text, a folder per language with a file per writing task; each document keeps its own lines."""
    path = fresh_path(spark, name)
    docs = table(spark, sf, "documents").select("lang", F.col("text").alias("value"))
    docs.write.partitionBy("lang").text(path)
    return path


@query("src_14_file_scan_by_mtime", r"""
    SELECT lang, sum(length(text) - length(replace(text, chr(10), '')) + 1) AS lines, sum(length(text)) AS chars
    FROM documents GROUP BY lang
""")
def _(spark, sf):
    got = files.file_scan(spark, _as_files(spark, sf, "scan"), "*.txt", True, "2001-01-01 00:00:00")
    whole = got.select(F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang"), "content")
    # The writer ends every document with a line break.
    per = whole.select("lang", (F.size(F.split("content", "\n")) - 1).alias("lines"), F.length("content").alias("n"))
    docs = table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    return per.groupBy("lang").agg(F.sum("lines").alias("lines"), F.sum("n").alias("n")).join(docs, "lang").select(
        "lang", "lines", (F.col("n") - F.col("docs")).alias("chars")
    )


@query("src_15_header_row_table", """
    SELECT p_partkey + 2 AS row_index, CAST(p_partkey AS VARCHAR) AS part_key,
           CASE WHEN p_size % 7 = 0 THEN '' ELSE p_name END AS name_en,
           CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS _col2
    FROM part
""")
def _(spark, sf):
    part = table(spark, sf, "part")
    name = F.when(F.col("p_size") % 7 != 0, F.col("p_name"))
    full = F.array(F.col("p_partkey").cast("string"), name, F.col("p_brand"), F.lit("beyond"))
    cells = F.when(F.col("p_size") % 5 == 0, F.slice(full, 1, 2)).otherwise(full)
    body = part.select((F.col("p_partkey") + 2).alias("row_index"), cells.alias("values"))
    head = part.filter("p_partkey = 0").select(F.lit(1).cast("bigint").alias("row_index"), F.array(F.lit(" part key "), F.lit("name--(en)"), F.lit(" ")).alias("values"))
    return files.header_row_table(head.unionByName(body))


@query("src_16_csv_report", """
    SELECT c_custkey AS customer_key, nullif(CASE WHEN c_nationkey < 5 THEN '' ELSE c_mktsegment END, '') AS market_segment
    FROM customer
""")
def _(spark, sf):
    path = fresh_path(spark, "report")
    cust = table(spark, sf, "customer")
    seg = F.when(F.col("c_nationkey") >= 5, F.col("c_mktsegment")).otherwise("")
    cust.select(F.col("c_custkey").alias("Customer Key"), seg.alias("Market Segment")).write.option("header", "true").option("emptyValue", "").csv(path)
    got = files.csv_report(spark, path)
    return got.select(F.col("customer_key").cast("bigint").alias("customer_key"), "market_segment")


@query("src_17_ndjson_good", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    return _ndjson(spark, sf)[0].select("event_id", "event_type", "k")


@query("src_17_ndjson_bad", "SELECT count(*) AS bad_lines FROM events WHERE user_id < 10")
def _(spark, sf):
    return _ndjson(spark, sf)[1].agg(F.count(F.lit(1)).alias("bad_lines"))


def _ndjson(spark, sf):
    """The events as JSON lines, with a blank line each and a broken one for users below 10."""
    path = fresh_path(spark, "lines")
    ev = table(spark, sf, "events")
    good = F.to_json(F.struct("event_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k")))
    broken = F.when(F.col("user_id") < 10, F.lit('{"event_id": 1, "event_type'))
    ev.select(F.concat_ws("\n", good, F.lit(""), broken).alias("value")).write.text(path)
    return files.ndjson_scan(spark, path, "event_id bigint, event_type string, k bigint")


@query("src_18_unwrap_records", """
    SELECT o_orderkey, o_custkey AS id FROM orders
    UNION ALL SELECT o_orderkey, o_custkey + 1 FROM orders
""")
def _(spark, sf):
    pair = F.array(F.struct(F.col("o_custkey").alias("id")), F.struct((F.col("o_custkey") + 1).alias("id")))
    plain = F.to_json(pair)
    hinted = F.to_json(F.struct(F.lit("x").alias("next"), pair.alias("events")))
    longest = F.to_json(F.struct(F.array(F.struct(F.lit(1).alias("q"))).alias("meta"), pair.alias("rows"), F.array(F.lit(1), F.lit(2), F.lit(3)).alias("nums")))
    body = F.when(F.col("o_orderstatus") == "F", plain).when(F.col("o_orderstatus") == "O", hinted).otherwise(longest)
    got = files.unwrap_records(table(spark, sf, "orders").select("o_orderkey", body.alias("body")), "body", ["events", "data"])
    return got.select("o_orderkey", F.try_variant_get("record", "$.id", "bigint").alias("id"))


def _history_log(spark, sf):
    ev = table(spark, sf, "events")
    message = F.struct(F.struct(F.col("user_id").alias("id"), F.pmod("user_id", F.lit(10)).alias("threadId")).alias("message"))
    none = F.array().cast("array<struct<message:struct<id:bigint,threadId:bigint>>>")
    gone = F.col("event_type") == "error"
    return ev.select(
        F.col("event_id").alias("id"),
        F.when(gone, none).otherwise(F.array(message)).alias("messagesAdded"),
        F.when(gone, F.array(message)).otherwise(none).alias("messagesDeleted"),
    )


@query("src_19_history_added", "SELECT user_id AS message_id, min(event_id) AS log_id FROM events WHERE event_type <> 'error' GROUP BY user_id")
def _(spark, sf):
    return feeds.history_added(_history_log(spark, sf))


@query("src_19_history_deleted_threads", "SELECT user_id % 10 AS id, min(event_id) AS log_id FROM events WHERE event_type = 'error' GROUP BY user_id % 10")
def _(spark, sf):
    return feeds.history_deleted(_history_log(spark, sf), "thread")


@query("src_20_delta_feed", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS at, o_orderstatus = 'F' AS _deleted
    FROM orders
""")
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumn("at", F.col("o_orderdate").cast("string"))
    return feeds.delta_feed(orders, ["o_orderkey"], F.col("o_orderstatus") == "F", "at", ["o_totalprice"])


@query("src_21_archived_as_deletes", """
    SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS cursor FROM orders
    WHERE o_orderstatus = 'P' AND o_orderdate > TIMESTAMP '1996-01-01'
""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    rows = feeds.archived_as_deletes(orders, F.col("o_orderstatus") == "P", "o_orderdate", "updated_at", "1996-01-01")
    return rows.select("o_orderkey", F.col("updated_at").cast("string").alias("cursor"))


@query("src_22_plan_time_partitions", """
    WITH s AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-02 23:55:00', TIMESTAMP '2024-01-28 06:00:00', INTERVAL 3 DAY)) AS lower)
    SELECT CAST(lower AS VARCHAR) AS lower, CAST(least(lower + INTERVAL 3 DAY, TIMESTAMP '2024-01-28 06:00:00') AS VARCHAR) AS upper,
           count(event_id) AS n, round(sum(value), 2) AS total
    FROM s LEFT JOIN events ON ts > lower AND ts <= least(lower + INTERVAL 3 DAY, TIMESTAMP '2024-01-28 06:00:00')
    WHERE lower < TIMESTAMP '2024-01-28 06:00:00' GROUP BY lower
""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    slices = inc.plan_time_partitions(spark, "2024-01-03 00:00:00", "2024-01-28 06:00:00", 3, 5)
    per = inc.with_slice(ev, "ts", "2024-01-03 00:00:00", "2024-01-28 06:00:00", 3, 5).groupBy("lower").agg(F.count("event_id").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    every = slices.join(per, "lower", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return every.select(F.col("lower").cast("string").alias("lower"), F.col("upper").cast("string").alias("upper"), "n", "total")


@query("src_23_balance_bins", """
    WITH w AS (SELECT o_orderkey, CAST(CASE WHEN o_custkey % 11 = 0 THEN 1 ELSE o_custkey % 11 END AS DOUBLE) AS w FROM orders),
    r AS (SELECT o_orderkey, w, sum(w) OVER (ORDER BY o_orderkey) AS run, sum(w) OVER () AS total FROM w)
    SELECT o_orderkey, CAST(least(floor((run - w) * 7 / total), 6) AS INTEGER) AS bin FROM r
""")
def _(spark, sf):
    units = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 11).alias("weight"))
    return inc.balance_bins(units, "weight", "o_orderkey", 7).select("o_orderkey", "bin")


@query("src_24_partition_read", "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag")
def _(spark, sf):
    rows = inc.snapshot_scan(spark, f"{sf}/lineitem.parquet")
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("src_25_full_list_refresh", """
    SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_nationkey >= 10
    UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey < 10
""")
def _(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    fresh = cust.filter("c_nationkey >= 10").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return inc.full_list_refresh(fresh, cust, ["c_custkey"])[0].select("c_custkey", "c_acctbal")


@query("src_25_full_list_refresh_with_repeats", "SELECT c_custkey, c_acctbal FROM customer")
def _(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return inc.full_list_refresh(cust.unionByName(cust.filter("c_custkey % 3 = 0")), cust.filter("c_custkey % 2 = 0"), ["c_custkey"])[0]


@query("src_26_peek_bounds", "SELECT CAST(min(ts) AS VARCHAR) AS oldest, CAST(max(ts) AS VARCHAR) AS newest FROM events")
def _(spark, sf):
    got = inc.peek_bounds(table(spark, sf, "events"), "ts")
    return got.select(F.col("oldest").cast("string").alias("oldest"), F.col("newest").cast("string").alias("newest"))


@query("src_27_filter_ignored_check", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def _(spark, sf):
    rows = inc.cursor_scan(table(spark, sf, "events"), "ts", "2024-01-20")
    inc.assert_newer(rows, "ts", "2024-01-20")
    return rows.select("event_id")


@query("src_28_keep_undated", """
    SELECT event_id FROM events WHERE event_type = 'signup' OR ts >= TIMESTAMP '2024-01-20'
""")
def _(spark, sf):
    ev = table(spark, sf, "events").withColumn("seen", F.when(F.col("event_type") != "signup", F.col("ts")))
    return inc.keep_undated(ev, "seen", "2024-01-20").select("event_id")


@query("src_29_list_files", "SELECT lang AS name, 'txt' AS type, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM documents GROUP BY lang")
def _(spark, sf):
    got = files.list_files(spark, _as_files(spark, sf, "listing"), "*.txt")
    return got.groupBy(F.regexp_extract("id", "lang=([^/]+)/", 1).alias("name"), "type").agg(F.sum("length").alias("bytes"))


@query("src_30_two_part_offset", """
    WITH rest AS (SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01'),
    cut AS (SELECT max(o_orderdate) AS c FROM (SELECT o_orderdate FROM rest ORDER BY o_orderdate LIMIT 400))
    SELECT o_orderkey FROM rest, cut WHERE o_orderdate <= c
""")
def _(spark, sf):
    start = {"start_time": "1995-01-01 00:00:00", "resume_after": "1996-01-01 00:00:00"}
    return inc.two_part_offset(table(spark, sf, "orders"), "o_orderdate", start, 400, "2002-01-01 00:00:00")[0].select("o_orderkey")


@query("src_31_limit_plus_one", """
    SELECT o_orderkey FROM (SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 600)
""")
def _(spark, sf):
    got = inc.limit_plus_one(table(spark, sf, "orders"), "o_orderdate", "o_orderkey", 600, "1996-01-01 00:00:00", "2002-01-01 00:00:00")
    return got[0].select("o_orderkey")


@query("src_32_per_parent_budget", """
    WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
    r AS (SELECT o_custkey, n, sum(n) OVER (ORDER BY o_custkey) AS run FROM c)
    SELECT o_orderkey, o.o_custkey FROM orders o JOIN r ON o.o_custkey = r.o_custkey WHERE run - n < 2000
""")
def _(spark, sf):
    return inc.per_parent_budget(table(spark, sf, "orders"), "o_custkey", 2000).select("o_orderkey", "o_custkey")


@query("src_34_default_time_range", """
    SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-14 22:00:00' AND ts <= TIMESTAMP '2024-01-18 22:00:00'
""")
def _(spark, sf):
    from datetime import datetime

    low, high = inc.default_time_range(datetime(2024, 1, 31), None, "2024-01-14 22:00:00", None, 60, 4 * 1440)
    return inc.cursor_scan(table(spark, sf, "events"), "ts", low, high).select("event_id")


@query("src_35_tombstone_scan", """
    SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS deleted_at FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '1998-01-01'
""")
def _(spark, sf):
    gone = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")
    return inc.tombstone_scan(gone, "o_orderdate", "1998-01-01").select("o_orderkey", F.col("o_orderdate").cast("string").alias("deleted_at"))


@query("src_36_skip_failed_parents", """
    SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0
""")
def _(spark, sf):
    good, _ = inc.skip_failed_parents(table(spark, sf, "customer"), F.col("c_acctbal") < 0)
    return table(spark, sf, "orders").join(good, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")


@query("win_8_resume_after_page", """
    SELECT CAST(min(last) + INTERVAL 1 MICROSECOND AS VARCHAR) AS resume_at
    FROM (SELECT event_type, max(ts) AS last FROM events GROUP BY event_type)
""")
def _(spark, sf):
    got = inc.resume_after_page(table(spark, sf, "events"), "event_type", "ts")
    return got.select(F.col("resume_at").cast("string").alias("resume_at"))


@query("flt_3_range_inclusive_mix", """
    SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate > TIMESTAMP '1996-01-01' AND l_shipdate <= TIMESTAMP '1996-12-31'
""")
def _(spark, sf):
    low, high = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")
    return table(spark, sf, "lineitem").filter(inc.in_slice("l_shipdate", low, high)).select("l_orderkey", "l_linenumber")


@query("fn_19_valid_uid", r"""
    SELECT vec_id, regexp_full_match(u, '[0-9.]+') AND NOT contains(u, '..') AS ok FROM (
        SELECT vec_id, CASE vec_id % 4 WHEN 0 THEN '1.2.' || vec_id WHEN 1 THEN '1..2' WHEN 2 THEN '../etc' ELSE repeat('1234567.', CAST(vec_id % 8 * 3 AS INTEGER)) || label END AS u FROM embeddings)
""")
def _(spark, sf):
    kind = F.col("vec_id") % 4
    uid = (
        F.when(kind == 0, F.concat(F.lit("1.2."), F.col("vec_id").cast("string"))).when(kind == 1, F.lit("1..2"))
        .when(kind == 2, F.lit("../etc")).otherwise(F.concat(F.repeat(F.lit("1234567."), (F.col("vec_id") % 8 * 3).cast("int")), F.col("label").cast("string")))
    )
    return table(spark, sf, "embeddings").select("vec_id", valid_uid(uid).alias("ok"))


@query("win_3_position_index", """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS position FROM events
""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return with_position(ev, ["event_type"], ["ts", "event_id"]).select("event_id", "event_type", (F.col("position") - 1).alias("position"))

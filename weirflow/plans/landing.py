"""Queries over change application and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.contracts import TableContract
from weirflow.operators import changes as ch
from weirflow.plans.registry import query, table
from weirflow.session import fresh_path
from weirflow.streaming import landing as st

ORDER_STATE = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query("snk_1_append", """
    SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM (
        SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'click') GROUP BY event_type
""")
def _(spark, sf):
    ev = table(spark, sf, "events")
    landed = ch.append(ev, ev.filter("event_type = 'click'"))
    return landed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("snk_2_scd1_upsert", """
    SELECT user_id, max(event_id) FILTER (r = 1) AS event_id, max(event_type) FILTER (r = 1) AS event_type, max(value) FILTER (r = 1) AS value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) GROUP BY user_id
""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    state = ch.visible(ch.scd1(None, ev, ["user_id"], ["ts", "event_id"]))
    return state.select("user_id", "event_id", "event_type", "value")


@query("snk_3_scd1_delete", """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
    SELECT user_id, event_id, value FROM r WHERE r = 1 AND event_type <> 'error'
""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    gone = ev.filter("event_type = 'error'").select("user_id", "ts", "event_id")
    early, late = ev.filter("event_type = 'view'"), ev.filter("event_type not in ('view', 'error')")
    state = ch.scd1(None, early, ["user_id"], ["ts", "event_id"])
    state = ch.scd1(state, late, ["user_id"], ["ts", "event_id"], gone)
    return ch.visible(state).select("user_id", "event_id", "value")


@query("snk_4_scd2_history", """
    WITH p AS (SELECT user_id, event_type, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
    k AS (SELECT * FROM p WHERE prev IS NULL OR prev <> event_type)
    SELECT user_id, event_type, CAST(ts AS VARCHAR) AS start_at, CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS VARCHAR) AS end_at FROM k
""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts")
    return _history_out(ch.scd2(ev, ["user_id"], "ts"))


def _history_out(hist):
    body = [c for c in hist.columns if not c.startswith("__")]
    return hist.select(*body, F.col("__START_AT").cast("string").alias("start_at"), F.col("__END_AT").cast("string").alias("end_at"))


DELETE_HISTORY = """
    WITH p AS (SELECT user_id, event_type, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
    k AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM p WHERE prev IS NULL OR prev <> event_type)
    SELECT user_id, event_type, CAST(ts AS VARCHAR) AS start_at, CAST(nxt AS VARCHAR) AS end_at FROM k WHERE event_type <> 'error'
"""


@query("snk_5_scd2_delete", DELETE_HISTORY)
def _(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts")
    gone = ev.filter("event_type = 'error'").select("user_id", "ts")
    return _history_out(ch.scd2(ev.filter("event_type <> 'error'"), ["user_id"], "ts", gone))


@query("snk_4_scd2_late_rows", """
    SELECT user_id, event_type, value, CAST(ts AS VARCHAR) AS start_at,
           CAST(nxt AS VARCHAR) AS end_at
    FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events) WHERE event_type <> 'error'
""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "value", "ts")
    late = "event_type = 'signup' OR ts > timestamp_ntz'2024-01-20'"
    ups, gone = ev.filter("event_type <> 'error'"), ev.filter("event_type = 'error'").select("user_id", "event_type", "ts")
    first = ch.scd2_state(ups.filter(f"NOT ({late})"), ["user_id"], "ts", gone.filter(f"NOT ({late})").drop("event_type"))
    return _history_out(ch.visible(ch.scd2_apply(first, ups.filter(late), ["user_id"], "ts", gone.filter(late).drop("event_type"))))


def _customers(spark, sf):
    """Customers before and after: some leave, some arrive, one segment changes balance."""
    cust = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    before = cust.filter("c_nationkey <> 3")
    moved = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    after = cust.filter("c_nationkey <> 7").withColumn("c_acctbal", moved)
    return before, after


AFTER = """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_nationkey
           FROM customer WHERE c_nationkey <> 7"""


@query("snk_6_snapshot_scd1", f"SELECT c_custkey, c_acctbal FROM ({AFTER})")
def _(spark, sf):
    before, after = _customers(spark, sf)
    return ch.snapshot_scd1(before, after, ["c_custkey"])[0].select("c_custkey", "c_acctbal")


@query("snk_6_snapshot_changes", """
    SELECT CASE WHEN c_nationkey = 3 THEN 'insert' WHEN c_nationkey = 7 THEN 'delete' WHEN c_mktsegment = 'BUILDING' THEN 'update' ELSE 'same' END AS _change,
           count(*) AS n FROM customer GROUP BY 1
""")
def _(spark, sf):
    before, after = _customers(spark, sf)
    return ch.snapshot_scd1(before, after, ["c_custkey"])[1]


@query("snk_7_snapshot_scd2", """
    WITH c AS (SELECT c_custkey, c_acctbal, c_nationkey AS nk, c_mktsegment = 'BUILDING' AS moved FROM customer)
    SELECT c_custkey, c_acctbal, 1 AS start_at, CASE WHEN nk = 7 OR moved THEN 2 END AS end_at FROM c WHERE nk <> 3
    UNION ALL
    SELECT c_custkey, CASE WHEN moved THEN c_acctbal + 1 ELSE c_acctbal END, 2, NULL FROM c WHERE nk = 3 OR (moved AND nk <> 7)
""")
def _(spark, sf):
    before, after = _customers(spark, sf)
    hist = before.select("c_custkey", "c_acctbal", F.lit(1).alias(ch.START), F.lit(None).cast("int").alias(ch.END))
    got = ch.snapshot_scd2(hist, after.select("c_custkey", "c_acctbal"), ["c_custkey"], F.lit(2))
    return got.select("c_custkey", "c_acctbal", F.col(ch.START).alias("start_at"), F.col(ch.END).alias("end_at"))


@query("snk_8_cluster_by", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' GROUP BY ALL
""")
def _(spark, sf):
    path = fresh_path(spark, "clustered")
    ch.write_clustered(table(spark, sf, "lineitem"), path, ["l_shipdate", "l_orderkey"])
    year = spark.read.parquet(path).filter("l_shipdate >= timestamp_ntz'1996-01-01' AND l_shipdate < timestamp_ntz'1997-01-01'")
    return year.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("snk_9_run_spec", """
    SELECT 'main.raw.clients' AS destination, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer
    UNION ALL SELECT 'events', 2 * count(*), CAST(2 * sum(event_id) AS BIGINT) FROM events
    UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus <> 'F'
""")
def _(spark, sf):
    cust, ev, orders = (table(spark, sf, t) for t in ("customer", "events", "orders"))
    gone = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")
    registry = {
        "customer": (TableContract("customer", ("c_custkey",), None, "snapshot"), lambda: (cust.unionByName(cust.filter("c_custkey % 5 = 0")), None)),
        "events": (TableContract("events", (), None, "append"), lambda: (ev, None)),
        "orders": (TableContract("orders", ("o_orderkey",), "o_orderdate", "cdc_with_deletes"), lambda: (orders, gone)),
    }
    spec = {"connection_name": "given", "objects": [
        {"table": {"source_table": "customer", "destination_catalog": "main", "destination_schema": "raw", "destination_table": "clients"}},
        {"table": {"source_table": "events", "table_configuration": {"scd_type": "append_only", "cluster_by": "user_id"}}},
        {"table": {"source_table": "orders", "table_configuration": {"scd_type": "SCD_TYPE_1", "sequence_by": "o_orderdate"}}},
    ]}
    root = fresh_path(spark, "landed")
    for version in (0, 1):
        tables = st.run_spec(spark, spec, registry, root, version)
    keys = {"main.raw.clients": "c_custkey", "events": "event_id", "orders": "o_orderkey"}
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(keys[name]).alias("keys")).select(F.lit(name).alias("destination"), "n", "keys")
        for name, df in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("snk_11_upsert_and_delete_row", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").withColumn("seq", F.lit(0))
    ups = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.lit("X")).withColumn("seq", F.lit(1))
    gone = orders.filter("o_orderpriority = '5-LOW'").select("o_orderkey").withColumn("seq", F.lit(2))
    state = ch.scd1(orders, ups, ["o_orderkey"], ["seq"], gone)
    return ch.visible(state).select("o_orderkey", "o_orderstatus")


@query("snk_12_binary_files", "SELECT page_id, octet_length(encode(html)) AS size FROM pages")
def _(spark, sf):
    pages = table(spark, sf, "pages")
    root = fresh_path(spark, "blobs")
    rows = pages.select("page_id", F.concat_ws("/", F.lit("pages"), F.parse_url("url", F.lit("HOST")), F.concat("page_id", F.lit(".html"))).alias("path"), F.encode("html", "UTF-8").alias("body"))
    written = ch.write_blobs(rows, root, "path", "body").select("page_id", "written_path")
    paths = fresh_path(spark, "blob-paths")
    written.write.parquet(paths)
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/pages")
    name = lambda c: F.regexp_extract(c, "/(blobs-[0-9a-f]+/pages/.*)$", 1).alias("name")
    stored = stored.select(name("path"), F.col("length").alias("size"))
    return spark.read.parquet(paths).select("page_id", name("written_path")).join(stored, "name").select("page_id", "size")


# --- streaming -----------------------------------------------------------------------------


def _event_files(spark, sf):
    """The events as files in time order, as many as the session has shuffle partitions, to be read as a stream."""
    path = fresh_path(spark, "events")
    ev = table(spark, sf, "events")
    ev.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "ts").write.parquet(path)
    return path, spark.read.parquet(path).schema


@query("str_1_available_now_drain", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    path, schema = _event_files(spark, sf)
    out = fresh_path(spark, "drained")
    st.drain(
        st.stream_files(spark, path, schema, files_per_batch=2),
        lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/b={number}"), fresh_path(spark, "cp"),
    )
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


LATEST = """
    SELECT user_id, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
"""


@query("str_3_upsert_stream", LATEST)
def _(spark, sf):
    path, schema = _event_files(spark, sf)
    target = st.UpsertTable(spark, fresh_path(spark, "state"), ["user_id"], ["ts", "event_id"], compact_every=2)
    st.upsert_stream(st.stream_files(spark, path, schema, files_per_batch=2), target, fresh_path(spark, "cp"))
    return target.read().select("user_id", "event_id", "value")


@query("str_4_delete_stream", LATEST + " AND event_type <> 'error'")
def _(spark, sf):
    path, schema = _event_files(spark, sf)
    target = st.UpsertTable(spark, fresh_path(spark, "state"), ["user_id"], ["ts", "event_id"], compact_every=2)
    ev = st.stream_files(spark, path, schema, files_per_batch=3)
    ups = ev.filter("event_type <> 'error'")
    gone = ev.filter("event_type = 'error'").select("user_id", "ts", "event_id")
    st.upsert_stream(st.with_deletes(ups, gone), target, fresh_path(spark, "cp"))
    return target.read().select("user_id", "event_id", "value")


@query("str_5_append_stream", "SELECT event_id, user_id, value FROM events")
def _(spark, sf):
    path, schema = _event_files(spark, sf)
    out, cp = fresh_path(spark, "appended"), fresh_path(spark, "cp")
    for _ in range(2):  # a second run from the same checkpoint adds nothing
        st.append_stream(st.stream_files(spark, path, schema, files_per_batch=2), out, cp)
    return spark.read.parquet(out).select("event_id", "user_id", "value")


@query("str_6_late_data_lookback", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    path, _ = _event_files(spark, sf)
    twice = fresh_path(spark, "overlap")
    rows = spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    out, cp = fresh_path(spark, "deduped"), fresh_path(spark, "cp")
    # The tail of the first read comes again with the second, as a lookback read gives it.
    for part, when in (("a", "ts <= timestamp'2024-01-16'"), ("b", "ts > timestamp'2024-01-15'")):
        rows.filter(when).write.parquet(f"{twice}/{part}")
        stream = st.stream_files(spark, f"{twice}/*", rows.schema)
        st.append_stream(st.drop_late_duplicates(stream, ["event_id"], "ts", "40 days"), out, cp)
    return spark.read.parquet(out).select("event_id", "user_id")


def _twice_read(spark, sf, token=None):
    """Events landed by watermarks of their type from files that come a second time; the landed rows and the marks."""
    path, _ = _event_files(spark, sf)
    again, out, cp = fresh_path(spark, "again"), fresh_path(spark, "landed"), fresh_path(spark, "cp")
    rows = spark.read.parquet(path)
    marks = st.UpsertTable(spark, fresh_path(spark, "marks"), ["event_type"], ["watermark"] + (["token"] if token else []), compact_every=2)
    for part, when in (("a", "ts <= timestamp_ntz'2024-01-16'"), ("b", "true")):
        rows.filter(when).write.parquet(f"{again}/{part}")
        st.watermark_stream(
            st.stream_files(spark, f"{again}/*", rows.schema), ["event_type"], "ts", marks,
            lambda fresh, number: fresh.write.mode("overwrite").parquet(f"{out}/b={number}"), cp, token,
        )
    return spark.read.parquet(out), marks


@query("str_7_per_key_watermark_state", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    return _twice_read(spark, sf)[0].select("event_id", "event_type")


@query("str_7_resume_tokens", """
    SELECT event_type, CAST(max(ts) AS VARCHAR) AS watermark, max(event_id) FILTER (ts = last) AS token, count(*) AS landed
    FROM (SELECT *, max(ts) OVER (PARTITION BY event_type) AS last FROM events) GROUP BY event_type
""")
def _(spark, sf):
    rows, marks = _twice_read(spark, sf, "event_id")
    landed = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("landed"))
    return marks.read().join(landed, "event_type").select("event_type", F.col("watermark").cast("string").alias("watermark"), "token", "landed")


@query("str_8_round_trip_check", "SELECT 0 AS only_batch, 0 AS only_stream")
def _(spark, sf):
    path, schema = _event_files(spark, sf)
    out = fresh_path(spark, "copied")
    st.append_stream(st.stream_files(spark, path, schema, files_per_batch=2), out, fresh_path(spark, "cp"))
    return st.round_trip(table(spark, sf, "events"), spark.read.parquet(out))

"""Queries over data checks and the table registry."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from weirflow.contracts import TableContract, decode_option
from weirflow.operators import quality as dq
from weirflow.operators.aggregates import table_counts
from weirflow.plans.registry import query, table
from weirflow.sources import incremental as inc


@query("dq_2_non_nullable", """
    SELECT o_orderkey, 'status' AS "column" FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'who.cust' FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def _(spark, sf):
    shape = T.StructType([
        T.StructField("o_orderkey", T.LongType(), False), T.StructField("status", T.StringType(), False),
        T.StructField("who", T.StructType([T.StructField("cust", T.LongType(), False), T.StructField("name", T.StringType())])),
    ])
    who = F.struct(F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("cust"), F.lit("x").alias("name"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"), who.alias("who"))
    return dq.non_nullable(rows, shape, ["o_orderkey"])


@query("dq_3_all_null_rows", "SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def _(spark, sf):
    good = F.col("c_acctbal") >= 0
    rows = table(spark, sf, "customer").select("c_custkey", F.when(good, F.col("c_name")).alias("name"), F.struct(F.when(good, F.col("c_mktsegment")).alias("seg")).alias("s"))
    return dq.all_null_rows(rows, ["c_custkey"]).select("c_custkey")


@query("dq_4_null_primary_key", "SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'")
def _(spark, sf):
    bad = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", F.when(~bad, F.col("l_orderkey")).alias("k1"), "l_linenumber")
    return dq.null_primary_key(rows, ["k1", "l_linenumber"]).select("l_partkey", "l_suppkey")


@query("dq_5_unpopulated_columns", "SELECT 'never' AS \"column\" UNION ALL SELECT 'e' WHERE (SELECT count(*) FROM events WHERE event_type = 'nothing') = 0")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.lit(None).cast("string").alias("never"), F.lit(None).cast("int").alias("allowed"),
                                             F.when(F.col("event_type") == "nothing", F.col("value")).alias("e"))
    return dq.unpopulated_columns(rows, ["allowed"])


@query("dq_6_uncovered_fields", """
    SELECT DISTINCT unnest(CASE WHEN o_orderstatus = 'O' THEN ['deep.extra', 'top'] WHEN o_orderstatus = 'F' THEN ['deep.extra', 'list.z'] ELSE ['deep.extra'] END) AS path FROM orders
    UNION ALL
    SELECT array_to_string(list_transform(range(1, d + 1), lambda i: CASE WHEN i = 1 THEN 'chain' ELSE 'c' || i END), '.') FROM range(1, (SELECT CAST(max(o_orderkey % 7) AS INTEGER) FROM orders) + 13) t(d)
""")
def _(spark, sf):
    inner = F.struct(F.col("o_custkey").alias("known"), F.col("o_orderpriority").alias("extra"))
    items = F.array(F.struct(F.col("o_orderkey").alias("a")).alias("i"))
    late = F.array(F.struct(F.lit(None).cast("bigint").alias("a"), F.when(F.col("o_orderstatus") == "F", F.lit(1)).alias("z")))
    body = F.to_json(F.struct(F.col("o_orderkey").alias("id"), inner.alias("deep"), F.when(F.col("o_orderstatus") == "O", F.lit(1)).alias("top"),
                              F.create_map(F.lit("any"), F.col("o_custkey")).alias("free"), F.when(F.col("o_orderstatus") == "F", late).alias("list")))
    # Chains of 12 to 18 objects in each other, by order.
    levels = F.sequence(F.lit(2).cast("long"), F.col("o_orderkey") % 7 + 12)
    chain = F.aggregate(F.reverse(levels), F.lit("1"), lambda acc, i: F.concat(F.lit('{"c'), i.cast("string"), F.lit('":'), acc, F.lit("}")))
    body = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(',"chain":'), chain, F.lit("}"))
    shape = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("deep", T.StructType([T.StructField("known", T.LongType())])),
        T.StructField("free", T.MapType(T.StringType(), T.LongType())), T.StructField("list", T.ArrayType(T.StructType([T.StructField("a", T.LongType())]))),
    ])
    return dq.uncovered_fields(table(spark, sf, "orders").select(body.alias("b")), "b", shape)


@query("dq_8_write_read_back", """
    SELECT 'lost keys' AS fault, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'row count', count(*) FROM orders WHERE o_orderstatus <> 'F'
""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    before, written = orders.filter("o_orderstatus = 'O'"), orders.filter("o_orderstatus <> 'O'")
    after = orders.filter("o_orderstatus <> 'F'")
    return dq.write_read_back(before, written, after, ["o_orderkey"], "snapshot")


@query("dq_9_partitions_stable", """
    SELECT 'read twice' AS fault, count(*) AS n FROM events WHERE event_type = 'view' UNION ALL SELECT 'never read', count(*) FROM events WHERE event_type = 'click'
""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("partition"))
    plan = ev.filter("event_type <> 'click'").unionByName(ev.filter("event_type = 'view'").withColumn("partition", F.date_add("partition", 1)))
    return dq.partitions_stable(plan, plan, ev, ["event_id"])


@query("dq_10_future_rows", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-25 12:00:00'")
def _(spark, sf):
    ev = table(spark, sf, "events")
    cap = "2024-01-25 12:00:00"
    capped = inc.cursor_scan(ev, "ts", None, cap)
    # The capped read holds none; what is left over is what the next run reads.
    return dq.future_rows(ev, "ts", cap).select("event_id").unionByName(dq.future_rows(capped, "ts", cap).select("event_id"))


@query("cat_6_option_decode", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')")
def _(spark, sf):
    wanted = decode_option('["BUILDING", "FURNITURE"]', list, "segments")
    return table(spark, sf, "customer").filter(F.col("c_mktsegment").isin(wanted)).select("c_custkey")

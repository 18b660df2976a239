"""Queries over projections, filters, sorting, set operations and row generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions.scalars import parse_hl7_dtm
from weirflow.operators import explode as ex, filters as fl, shaping as sh
from weirflow.operators.quality import shape_drift
from weirflow.plans.registry import query, table


def _nested(spark, sf):
    """Orders as nested records."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.struct(
            F.struct(F.col("o_custkey").alias("custKey"), F.col("o_orderpriority").alias("orderPriority")).alias("buyerInfo"),
            F.col("o_totalprice").alias("totalPrice"),
            F.array(F.struct(F.col("o_orderstatus").alias("statusCode"))).alias("stateList"),
        ).alias("orderBody"),
    )


@query("prj_3_set_path", """
    SELECT o_orderkey, o_custkey AS kept, o_totalprice * 2 AS changed, 'new' AS added FROM orders
""")
def _(spark, sf):
    rows = sh.set_path(_nested(spark, sf), "orderBody.totalPrice", F.col("orderBody.totalPrice") * 2)
    rows = sh.set_path(rows, "orderBody.extra.deep.note", F.lit("new"))
    return rows.select("o_orderkey", F.col("orderBody.buyerInfo.custKey").alias("kept"), F.col("orderBody.totalPrice").alias("changed"),
                       F.col("orderBody.extra.deep.note").alias("added"))


@query("prj_4_flatten_struct", """
    SELECT o_orderkey, o_custkey AS "orderBody_buyerInfo_custKey", o_totalprice AS "orderBody_totalPrice" FROM orders
""")
def _(spark, sf):
    return sh.flatten_struct(_nested(spark, sf), ["orderBody.buyerInfo.custKey", "orderBody.totalPrice"], ["o_orderkey"])


@query("prj_5_snake_case_keys", """
    SELECT o_orderkey, o_custkey AS cust_key, o_orderpriority AS order_priority, o_totalprice AS total_price, o_orderstatus AS status_code FROM orders
""")
def _(spark, sf):
    rows = sh.snake_keys(_nested(spark, sf))
    return rows.select("o_orderkey", "order_body.buyer_info.cust_key", "order_body.buyer_info.order_priority", "order_body.total_price",
                       F.col("order_body.state_list")[0]["status_code"].alias("status_code"))


@query("prj_6_nullify_empty_struct", "SELECT c_custkey, c_acctbal < 0 AS gone FROM customer")
def _(spark, sf):
    good = F.col("c_acctbal") >= 0
    part = F.struct(F.when(good, F.col("c_name")).alias("name"), F.when(good, F.col("c_mktsegment")).alias("segment"))
    rows = sh.nullify_empty_struct(table(spark, sf, "customer").select("c_custkey", part.alias("info")), ["info"])
    return rows.select("c_custkey", F.col("info").isNull().alias("gone"))


@query("prj_7_clean_empty_deep", "SELECT c_custkey, c_acctbal < 0 AS outer_gone, c_acctbal < 0 AS item_gone FROM customer")
def _(spark, sf):
    good = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    deep = F.struct(F.struct(good.alias("x")).alias("inner"))
    rows = table(spark, sf, "customer").select("c_custkey", deep.alias("a"), F.array(deep).alias("list"))
    got = sh.clean_empty_deep(rows)
    return got.select("c_custkey", F.col("a").isNull().alias("outer_gone"), F.col("list")[0].isNull().alias("item_gone"))


@query("prj_8_blank_to_null", "SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN NULL ELSE c_mktsegment END AS segment FROM customer")
def _(spark, sf):
    seg = F.when(F.col("c_nationkey") < 5, F.lit("")).otherwise(F.col("c_mktsegment"))
    return sh.blank_to_null(table(spark, sf, "customer").select("c_custkey", seg.alias("segment")), ["segment"])


@query("prj_9_split_properties", """
    SELECT event_id, user_id AS distinct_id, value AS time, CAST(json_extract(props, '$.k') AS VARCHAR) AS custom_k, 2 AS customs FROM events
""")
def _(spark, sf):
    body = F.to_json(F.struct(F.col("user_id").alias("distinct_id"), F.col("value").alias("time"),
                              F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("kind")))
    rows = sh.split_properties(table(spark, sf, "events").select("event_id", body.alias("p")), "p", {"distinct_id": "bigint", "time": "double"})
    return rows.select("event_id", "p.distinct_id", "p.time", F.col("p.custom_properties")["k"].alias("custom_k"),
                       F.size("p.custom_properties").alias("customs"))


@query("prj_10_serialize_complex", """
    SELECT o_orderkey, '{"custKey":' || o_custkey || ',"orderPriority":"' || o_orderpriority || '"}' AS buyer, '[{"statusCode":"' || o_orderstatus || '"}]' AS states FROM orders
""")
def _(spark, sf):
    rows = _nested(spark, sf).select("o_orderkey", F.col("orderBody.buyerInfo").alias("buyer"), F.col("orderBody.stateList").alias("states"))
    return sh.serialize_complex(rows)


@query("prj_11_strip_odata", """
    SELECT s_suppkey, s_name AS name, '{"nation":' || s_nationkey || '}' AS home, 2 AS fields FROM supplier
""")
def _(spark, sf):
    raw = F.to_json(F.struct(
        F.struct(F.lit("u").alias("uri")).alias("__metadata"), F.col("s_name").alias("name"),
        F.struct(F.struct(F.lit("l").alias("uri")).alias("__deferred")).alias("orders"),
        F.struct(F.lit("m").alias("__metadata"), F.col("s_nationkey").alias("nation")).alias("home"),
    ))
    got = sh.strip_meta(table(spark, sf, "supplier").select("s_suppkey", raw.alias("r")), "r")
    return got.select("s_suppkey", F.col("r")["name"].alias("name"), F.col("r")["home"].alias("home"), F.size("r").alias("fields"))


@query("prj_11_strip_odata_deep", """
    SELECT s_suppkey, '{"a":{"b":{"n":' || s_nationkey || '}}}' AS marked, '{"__n":' || s_nationkey || ',"x":1}' AS unmarked FROM supplier
""")
def _(spark, sf):
    mark = F.struct(F.lit("u").alias("uri")).alias("__metadata")
    link = F.struct(F.struct(F.lit("l").alias("uri")).alias("__deferred")).alias("more")
    inner = F.struct(mark, F.col("s_nationkey").alias("n"), link)
    raw = F.to_json(F.struct(F.struct(mark, F.struct(mark, inner.alias("b")).alias("a")).alias("marked"), F.struct(F.col("s_nationkey").alias("__n"), F.lit(1).alias("x")).alias("unmarked")))
    got = sh.strip_meta(table(spark, sf, "supplier").select("s_suppkey", raw.alias("r")), "r")
    return got.select("s_suppkey", F.col("r")["marked"].alias("marked"), F.col("r")["unmarked"].alias("unmarked"))


@query("prj_12_inject_keys", "SELECT r_regionkey, r_name, 'acme' AS organization, 'north' AS repository FROM region")
def _(spark, sf):
    return sh.inject_keys(table(spark, sf, "region"), organization="acme", repository="north")


@query("prj_14_hoist_and_derive", """
    SELECT o_orderkey, o_custkey AS buyer, o_custkey || '/orders/' || o_orderkey AS url,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_orderstatus END AS label FROM orders
""")
def _(spark, sf):
    rows = _nested(spark, sf).withColumn("kind", F.lit("orders"))
    rows = rows.withColumn("modify", F.nullif(F.col("orderBody.stateList")[0]["statusCode"], F.lit("F")))
    got = sh.hoist_and_derive(rows, {"buyer": "orderBody.buyerInfo.custKey", "create": "orderBody.buyerInfo.orderPriority"},
                              ["buyer", "kind", "o_orderkey"], {"label": ["modify", "create"]})
    return got.select("o_orderkey", "buyer", "url", "label")


@query("prj_15_associations_to_ids", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_custkey || ',' || (o_custkey + 1) WHEN 'O' THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS companies,
           '' AS deals FROM orders
""")
def _(spark, sf):
    two = F.array(F.struct(F.col("o_custkey").cast("string").alias("id")), F.struct((F.col("o_custkey") + 1).cast("string").alias("id")))
    wrapped = F.to_json(F.struct(F.struct(two.alias("results")).alias("companies")))
    plain = F.to_json(F.struct(F.slice(two, 1, 1).alias("companies")))
    text = F.when(F.col("o_orderstatus") == "F", wrapped).when(F.col("o_orderstatus") == "O", plain).otherwise("{}")
    rows = table(spark, sf, "orders").select("o_orderkey", F.try_parse_json(text).alias("v"))
    return rows.select("o_orderkey", *[F.array_join(sh.associations_to_ids(F.col("v"), k), ",").alias(k) for k in ("companies", "deals")])


def _responses(spark, sf):
    """Conversations as survey responses."""
    entry = F.struct(F.col("text").alias("textEntry"), F.concat(F.lit("c"), F.col("turn").cast("string")).alias("choiceId"))
    # Metadata sits on top for users and inside the values for everybody else.
    top = F.when(F.col("role") == "user", F.col("role"))
    values = F.struct(entry.alias("QID1"), F.col("turn").cast("string").alias("QID2"),
                      F.struct(F.when(F.col("role") != "user", F.col("role")).alias("textEntry")).alias("status"))
    body = F.to_json(F.struct(F.col("conv_id").alias("responseId"), top.alias("status"), values.alias("values")))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.try_parse_json(body).alias("v"))


@query("prj_16_first_of_fallback", "SELECT conv_id, turn, role AS status, CAST(conv_id AS VARCHAR) AS response_id FROM conversations")
def _(spark, sf):
    return _responses(spark, sf).select("conv_id", "turn", sh.first_of_fallback(F.col("v"), "status").alias("status"),
                                        sh.first_of_fallback(F.col("v"), "responseId").alias("response_id"))


@query("prj_16_record_id", """
    SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'own' WHEN turn % 3 = 1 THEN 'R' || conv_id ELSE 'r' || turn END AS response_id FROM conversations
""")
def _(spark, sf):
    rest = F.col("turn") % 3
    own = F.when(rest == 0, F.lit("own")).when(rest == 1, F.lit(""))
    named, plain = F.struct(F.concat(F.lit("R"), F.col("conv_id")).alias("textEntry")), F.concat(F.lit("r"), F.col("turn"))
    record = F.when(rest == 2, F.to_json(F.struct(F.struct(plain.alias("_recordId")).alias("values")))).otherwise(F.to_json(F.struct(own.alias("responseId"), F.struct(named.alias("_recordId")).alias("values"))))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.try_parse_json(record).alias("v"))
    return rows.select("conv_id", "turn", sh.first_of_fallback(F.col("v"), "responseId").alias("response_id"))


@query("prj_17_answers_map", """
    SELECT conv_id, turn, 2 AS answers, md5(text) AS text_entry, 'c' || turn AS choice, CAST(turn AS VARCHAR) AS plain FROM conversations
""")
def _(spark, sf):
    got = _responses(spark, sf).select("conv_id", "turn", sh.answers_map(F.try_variant_get("v", "$.values", "variant")).alias("a"))
    return got.select("conv_id", "turn", F.size("a").alias("answers"), F.md5(F.col("a")["QID1"]["textEntry"]).alias("text_entry"),
                      F.col("a")["QID1"]["choiceId"].alias("choice"), F.col("a")["QID2"]["textEntry"].alias("plain"))


@query("prj_18_extension_lookup", "SELECT c_custkey, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS none FROM customer")
def _(spark, sf):
    one = lambda u, v: F.struct(F.lit(u).alias("url"), v.alias("valueString"))
    exts = F.array(one("http://x/name", F.col("c_name")), one("http://x/segment", F.col("c_mktsegment")), one("http://x/segment", F.col("c_name")))
    rows = table(spark, sf, "customer").select("c_custkey", exts.alias("e"))
    pick = lambda u: sh.first_where(F.col("e"), lambda x: x["url"] == u)["valueString"]
    return rows.select("c_custkey", pick("http://x/segment").alias("segment"), pick("http://x/none").alias("none"))


@query("prj_19_column_prune", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")


@query("prj_20_combine_singletons", """
    SELECT (SELECT count(*) FROM orders) AS orders, (SELECT max(c_acctbal) FROM customer) AS top_balance, true AS part_missing
""")
def _(spark, sf):
    orders = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"))
    cust = table(spark, sf, "customer").agg(F.max("c_acctbal").alias("top"))
    none = table(spark, sf, "region").filter("r_regionkey < 0").select("r_name")
    got = sh.combine_singletons({"orders": orders, "customers": cust, "region": none})
    return got.select(F.col("orders.n").alias("orders"), F.col("customers.top").alias("top_balance"), F.col("region").isNull().alias("part_missing"))


@query("prj_21_keyed_singleton", "SELECT 1 AS id, sum(l_quantity) AS quantity FROM lineitem")
def _(spark, sf):
    one = table(spark, sf, "lineitem").agg(F.sum("l_quantity").alias("quantity"))
    return sh.keyed_singleton(one, ["quantity", "currency"]).select("id", "quantity")


@query("prj_22_either_shape", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand FROM part")
def _(spark, sf):
    key, name, brand = F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")
    flat, nested = F.to_json(F.struct(key, name, brand)), F.to_json(F.struct(key, F.struct(name, brand).alias("attributes")))
    body = F.try_parse_json(F.when(F.col("p_type") == "ECONOMY", flat).otherwise(nested))
    return table(spark, sf, "part").select(body.alias("v")).select(*sh.either_shape(F.col("v"), ["name", "brand"]))


# --- filters, order, sets ------------------------------------------------------------------


@query("flt_1_where_ops", """
    SELECT o_orderkey FROM orders WHERE o_totalprice >= 150000.5 AND o_custkey <> 7 AND o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus < 'P'
""")
def _(spark, sf):
    tests = [("o_totalprice", "gte", "150000.5"), ("o_custkey", "ne", "7"), ("o_orderpriority", "in", "1-URGENT, 5-LOW"), ("o_orderstatus", "lt", "P")]
    return fl.where_ops(table(spark, sf, "orders"), tests).select("o_orderkey")


@query("flt_1_where_ops_nulls", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def _(spark, sf):
    # The status is null for finished orders and a number for nobody: only ``ne`` may keep a null.
    rows = table(spark, sf, "orders").withColumn("k", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")))
    return fl.where_ops(rows, [("k", "gte", "0")]).select("o_orderkey")


@query("flt_2_bool_tree", """
    SELECT event_id FROM events WHERE (event_type = 'click' AND value > 100) OR user_id = 3 OR (event_type = 'view' AND value > 300 AND user_id > 50)
""")
def _(spark, sf):
    tree = """{"type": "or", "value": [
        {"type": "and", "value": [{"type": "eq", "field": "event_type", "value": "click"}, {"type": "gt", "field": "value", "value": 100}]},
        {"type": "eq", "field": "user_id", "value": 3},
        {"type": "and", "value": [{"type": "eq", "field": "event_type", "value": "view"}, {"type": "gt", "field": "value", "value": 300},
                                  {"type": "gt", "field": "user_id", "value": 50}]}]}"""
    return table(spark, sf, "events").filter(fl.bool_tree(tree)).select("event_id")


@query("flt_4_tag_filters", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey = 4")
def _(spark, sf):
    wanted = '{"c_mktsegment": ["BUILDING", "MACHINERY"], "c_nationkey": 4}'
    return fl.tag_filters(table(spark, sf, "customer"), wanted, ["limit", "offset"]).select("c_custkey")


@query("flt_5_regex_filter", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^s.*g$|widget')")
def _(spark, sf):
    return fl.regex_filter(table(spark, sf, "part"), "p_name", "^s.*g$|widget").select("p_partkey", "p_name")


@query("flt_6_name_filter", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 's%r_ng' ORDER BY p_partkey LIMIT 40")
def _(spark, sf):
    return fl.name_filter(table(spark, sf, "part"), "p_name", "S*r?ng", "p_partkey", 40).select("p_partkey", "p_name")


@query("srt_1_stable_sort", """
    SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END DESC NULLS FIRST, o_orderkey) AS place
    FROM orders
""")
def _(spark, sf):
    rows = table(spark, sf, "orders").withColumn("price", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")))
    ordered = fl.stable_sort(rows, "price", "desc", ["o_orderkey"]).select("o_orderkey", F.monotonically_increasing_id().alias("at"))
    from weirflow.operators.ordered import with_position

    return with_position(ordered, [], ["at"], "place").select("o_orderkey", "place")


@query("srt_2_batch_order", """
    SELECT event_id, row_number() OVER (ORDER BY CASE WHEN event_type = 'error' THEN '' ELSE event_type END, lpad(CAST(event_id AS VARCHAR), 12, '0')) AS place FROM events
""")
def _(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("create_time"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("source_file")
    )
    ordered = fl.batch_order(rows, "create_time", "source_file").select("event_id", F.monotonically_increasing_id().alias("at"))
    from weirflow.operators.ordered import with_position

    return with_position(ordered, [], ["at"], "place").select("event_id", "place")


@query("lim_1_top_n_latest", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def _(spark, sf):
    return fl.top_latest(table(spark, sf, "events"), "ts", 10, [F.col("event_id").desc()]).select("event_id", "event_type")


@query("lim_3_slice_page", "SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50 OFFSET 200")
def _(spark, sf):
    return fl.slice_page(table(spark, sf, "orders"), ["o_totalprice", "o_orderkey"], 200, 50).select("o_orderkey")


@query("lim_4_preview", "SELECT least(5, count(*)) AS n, least(5, count(s_name)) AS found, 4 AS columns FROM supplier")
def _(spark, sf):
    """Which rows a preview shows is open; all of them must be rows of the table."""
    suppliers = table(spark, sf, "supplier")
    got = fl.preview(suppliers, 5, {"region": "text"}, {"region": "EU"})
    held = suppliers.select(F.xxhash64(*suppliers.columns).alias("row"), F.lit(True).alias("held"))
    rows = got.select(F.xxhash64(*suppliers.columns).alias("row")).join(held, "row", "left")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count("held").alias("found")).withColumn("columns", F.lit(len(got.columns)))


@query("set_1_union_all", """
    SELECT s_nationkey AS nation, s_name AS name, NULL AS segment FROM supplier UNION ALL SELECT c_nationkey, c_name, c_mktsegment FROM customer
""")
def _(spark, sf):
    sup = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    cust = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return fl.union_all([sup, cust])


@query("set_2_distinct_ids", "SELECT DISTINCT l_suppkey AS id FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("id")).distinct()


def _drifted(spark, sf):
    """Event records before and after a day on which ids became text, one kind went and new fields came."""
    ev = table(spark, sf, "events")
    kind, user = F.concat(F.lit("t_"), F.col("event_type")), F.concat(F.lit("u_"), F.col("user_id") % 5)
    pair = lambda name, value: F.concat(F.lit('"'), name, F.lit('":'), value)
    record = lambda *pairs: F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    number = F.coalesce(F.col("value").cast("decimal(18,3)").cast("string"), F.lit("null"))
    before = ev.filter("ts < timestamp_ntz'2024-01-15'").select(record(pair(F.lit("id"), F.col("event_id").cast("string")), pair(kind, number)).alias("r"))
    after = ev.filter("ts >= timestamp_ntz'2024-01-15' AND event_type <> 'error'").select(record(pair(F.lit("id"), F.concat(F.lit('"e'), F.col("event_id"), F.lit('"'))), pair(kind, number), pair(user, F.lit("1"))).alias("r"))
    return fl.record_fields(after, "r"), fl.record_fields(before, "r")


@query("set_3_field_diff", """
    SELECT DISTINCT 'id' AS field, 'changed' AS status FROM events
    UNION ALL SELECT DISTINCT 't_' || event_type, CASE WHEN event_type = 'error' THEN 'missing' ELSE 'common' END FROM events
    UNION ALL SELECT DISTINCT 'u_' || (user_id % 5), 'extra' FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type <> 'error'
""")
def _(spark, sf):
    return fl.field_diff(*_drifted(spark, sf)).select("field", "status")


@query("dq_7_shape_drift", """
    SELECT DISTINCT 'id' AS field, 'str' AS live_type, 'int' AS expected_type FROM events
    UNION ALL SELECT DISTINCT 't_' || event_type, NULL, 'float' FROM events WHERE event_type = 'error'
""")
def _(spark, sf):
    return shape_drift(*_drifted(spark, sf)).select("field", "live_type", "expected_type")


# --- generators ----------------------------------------------------------------------------


@query("exp_1_child_events", """
    SELECT o_orderkey, l_linenumber, l_quantity AS amount, l_linestatus AS status FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
""")
def _(spark, sf):
    line = F.struct(F.when(F.col("l_returnflag") == "R", F.lit("Comment")).otherwise(F.lit("Change")).alias("event_type"),
                    F.col("l_linenumber"), F.col("l_quantity").alias("amount"), F.col("l_linestatus").alias("status"))
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    tickets = rows.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.array(line).alias("child_events"))
    return ex.child_events(tickets).select("o_orderkey", "l_linenumber", "amount", "status")


@query("exp_2_timetrack", """
    SELECT o_custkey AS "userId", o_orderkey AS "taskId", o_totalprice AS time FROM orders UNION ALL SELECT o_custkey, -o_orderkey, 0 FROM orders
""")
def _(spark, sf):
    rec = lambda k, t: F.struct(k.alias("taskId"), t.cast("double").alias("time"))
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("userId"), F.array(rec(F.col("o_orderkey"), F.col("o_totalprice")), rec(-F.col("o_orderkey"), F.lit(0))).alias("records")
    )
    return ex.record_rows(rows, "records")


@query("exp_3_pages_questions", """
    SELECT o_custkey AS survey_id, o_orderkey AS page_id, l_linenumber AS question_id, l_quantity AS score FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    question = F.struct(F.col("l_linenumber").alias("id"), F.col("l_quantity").alias("score"))
    page = F.struct(F.col("o_orderkey").alias("id"), F.array(question).alias("questions"))
    return ex.pages_questions(rows.select(F.col("o_custkey").alias("id"), F.array(page).alias("pages")))


@query("exp_4_series_to_rows", """
    SELECT o_orderkey, '2024-01-0' || d AS date, CASE s WHEN 1 THEN o_custkey ELSE o_orderkey END AS count, CASE s WHEN 1 THEN o_orderstatus ELSE 'Totals' END AS segment
    FROM orders, (VALUES (1, 1), (1, 2), (2, 1)) t(s, d)
""")
def _(spark, sf):
    head, tail = F.lit('{"series":[['), F.lit(']],"xValues":["2024-01-01","2024-01-02"],"seriesMeta":["')
    cust, key = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    body = F.concat(head, F.concat_ws(",", cust, cust, cust), F.lit("],["), key, tail, F.col("o_orderstatus"), F.lit('",{"segmentIndex":1}]}'))
    return ex.series_rows(table(spark, sf, "orders").select("o_orderkey", body.alias("body")), "body")


@query("exp_5_map_to_rows", """
    SELECT c_custkey, 'name' AS name, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer WHERE c_acctbal >= 0
""")
def _(spark, sf):
    m = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    return ex.map_rows(table(spark, sf, "customer").select("c_custkey", m.alias("links")), "links")


@query("exp_5_map_to_rows_blank", """
    SELECT c_custkey, 'segment' AS name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE '' END AS value FROM customer
""")
def _(spark, sf):
    m = F.create_map(F.lit("segment"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    return ex.map_rows(table(spark, sf, "customer").select("c_custkey", m.alias("columns")), "columns", skip_null=False)


TREE = """
    SELECT 'world' AS node, '' AS parent UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region
    UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
"""


@query("exp_6_tree_walk", f"""
    WITH RECURSIVE t AS ({TREE}), w AS (
        SELECT node, parent, 0 AS depth, node AS path FROM t WHERE parent = ''
        UNION ALL SELECT t.node, t.parent, w.depth + 1, w.path || '/' || t.node FROM t JOIN w ON t.parent = w.node)
    SELECT node, parent, depth, path FROM w
""")
def _(spark, sf):
    tag = lambda c, p: F.concat(F.lit(p), F.col(c).cast("string"))
    region = table(spark, sf, "region").select(tag("r_regionkey", "r").alias("node"), F.lit("world").alias("parent"))
    nation = table(spark, sf, "nation").select(tag("n_nationkey", "n").alias("node"), tag("n_regionkey", "r").alias("parent"))
    cust = table(spark, sf, "customer").select(tag("c_custkey", "c").alias("node"), tag("c_nationkey", "n").alias("parent"))
    root = table(spark, sf, "region").agg(F.lit("world").alias("node"), F.lit("").alias("parent"))
    return ex.tree_walk(fl.union_all([root, region, nation, cust]), "node", "parent")


@query("exp_6_nested_tree", """
    SELECT o_orderkey, 'a' || o_custkey AS element, '' AS parent, 0 AS depth FROM orders UNION ALL SELECT o_orderkey, 'b', 'a' || o_custkey, 1 FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, 'b', 2 FROM orders
""")
def _(spark, sf):
    leaf = F.array(F.struct(F.col("o_orderstatus").alias("id")))
    lost = F.struct(F.lit(None).cast("string").alias("id"), leaf.alias("children"))
    kept = F.struct(F.lit("b").alias("id"), leaf.alias("children"))
    body = F.to_json(F.struct(F.concat(F.lit("a"), F.col("o_custkey").cast("string")).alias("id"), F.array(kept, lost).alias("children")))
    rows = table(spark, sf, "orders").select("o_orderkey", F.try_parse_json(body).alias("n"))
    return ex.nested_tree(spark, rows, "n")


@query("exp_8_id_chunks", "SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 50) AS BIGINT) AS chunk FROM orders")
def _(spark, sf):
    return ex.id_chunks(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 50)


@query("exp_9_repetitions", """
    SELECT p_partkey, 2 AS n, p_brand AS code, strftime(TIMESTAMP '2024-01-01' + to_days(p_size), '%Y-%m-%dT00:00:00') AS at FROM part WHERE p_type <> 'ECONOMY'
    UNION ALL SELECT p_partkey, -1, NULL, NULL FROM part WHERE p_type = 'ECONOMY'
""")
def _(spark, sf):
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")), "yyyyMMdd")
    text = F.when(F.col("p_type") == "ECONOMY", F.lit("~~")).otherwise(F.concat(F.col("p_brand"), F.lit("^"), day, F.lit("~~x^")))
    part = lambda r: F.struct(F.split_part(r, F.lit("^"), F.lit(1)).alias("code"), parse_hl7_dtm(F.split_part(r, F.lit("^"), F.lit(2))).alias("at"))
    rows = table(spark, sf, "part").select("p_partkey", ex.repetitions(text, part).alias("r"))
    return rows.select("p_partkey", F.coalesce(F.size("r"), F.lit(-1)).alias("n"), F.col("r")[0]["code"].alias("code"), F.col("r")[0]["at"].alias("at"))

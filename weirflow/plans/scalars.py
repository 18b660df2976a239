"""Queries over the scalar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions import scalars as sc
from weirflow.functions.coerce import coerce
from weirflow.operators.shaping import get_path
from weirflow.plans.registry import query, table


@query("prj_1_coerce", """
    SELECT o_orderkey, o_custkey AS whole, o_orderstatus <> 'F' AS flag, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
           CAST(o_orderdate AS VARCHAR) AS at, o_totalprice AS price, o_orderstatus AS first_tag, 1 AS tags
    FROM orders
""")
def _(spark, sf):
    word = F.when(F.col("o_orderstatus") == "F", "no").when(F.col("o_orderstatus") == "O", "Yes").otherwise("maybe")
    body = F.to_json(F.struct(
        F.concat(F.col("o_custkey").cast("string"), F.lit(".75")).alias("whole"), word.alias("flag"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        F.struct(F.col("o_totalprice").cast("string").alias("price")).alias("money"), F.col("o_orderstatus").alias("tags"),
    ))
    shape = "whole bigint, flag boolean, day date, at timestamp, money struct<price:double>, tags array<string>"
    got = coerce(table(spark, sf, "orders").select("o_orderkey", body.alias("body")), "body", shape, "strict")
    return got.select(
        "o_orderkey", "whole", "flag", F.col("day").cast("string").alias("day"), F.col("at").cast("string").alias("at"),
        F.col("money.price").alias("price"), F.col("tags")[0].alias("first_tag"), F.size("tags").alias("tags"),
    )


@query("prj_1_coerce_lenient", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value
    FROM events
""")
def _(spark, sf):
    bad = F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    body = F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"), bad.alias("value")))
    return coerce(table(spark, sf, "events").select("event_id", body.alias("b")), "b", "k bigint, value double")


@query("fn_1_to_snake_case", "SELECT p_partkey, replace(p_name, ' ', '_') || '_id' AS name FROM part")
def _(spark, sf):
    camel = F.concat(F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.lit("Id"))
    return table(spark, sf, "part").select("p_partkey", sc.to_snake_case(camel).alias("name"))


@query("fn_2_safe_column_name", """
    SELECT page_id, CASE WHEN page_id % 9 = 0 THEN '_col' || page_id ELSE
        regexp_replace(regexp_replace(regexp_replace(url, '[^a-zA-Z0-9_]+', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') END AS name
    FROM pages
""")
def _(spark, sf):
    raw = F.when(F.col("page_id") % 9 == 0, F.lit(" ** ")).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", sc.safe_column_name(raw, F.col("page_id")).alias("name"))


@query("fn_4_parse_relative_time", """
    SELECT event_id, CAST(CASE event_type
        WHEN 'click' THEN TIMESTAMP '2024-02-01' - to_minutes(CAST(json_extract(props, '$.k') AS INTEGER))
        WHEN 'view' THEN TIMESTAMP '2024-02-01' - to_days(CAST(json_extract(props, '$.k') AS INTEGER))
        WHEN 'error' THEN date_trunc('second', ts) ELSE TIMESTAMP '2024-02-01' END AS VARCHAR) AS at
    FROM events
""")
def _(spark, sf):
    k = F.get_json_object("props", "$.k")
    text = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("*-"), k, F.lit("m")))
        .when(F.col("event_type") == "view", F.concat(F.lit("*-"), k, F.lit("d")))
        .when(F.col("event_type") == "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_type") == "signup", F.lit("*")).otherwise(F.lit("soon"))
    )
    at = sc.parse_relative_time(text, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return table(spark, sf, "events").select("event_id", at.cast("string").alias("at"))


@query("fn_5_parse_odata_date", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN event_type ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS at FROM events
""")
def _(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    zone = F.when(F.col("event_type") == "click", F.lit("+0100")).otherwise(F.lit(""))
    raw = F.when(F.col("event_type") == "view", F.col("event_type")).otherwise(F.concat(F.lit("/Date("), ms, zone, F.lit(")/")))
    return table(spark, sf, "events").select("event_id", sc.parse_odata_date(raw).alias("at"))


@query("fn_6_epoch_ms_to_iso", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN strftime(ts, '%g') = '000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '000+00:00' END AS at FROM events
""")
def _(spark, sf):
    ms = F.when(F.col("event_type") == "error", F.lit("never")).otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
    return table(spark, sf, "events").select("event_id", sc.epoch_ms_to_iso(ms).alias("at"))


@query("fn_7_parse_hl7_dtm", """
    SELECT event_id, CASE event_type WHEN 'click' THEN strftime(date_trunc('second', ts) - INTERVAL 150 MINUTE, '%Y-%m-%dT%H:%M:%S')
        WHEN 'view' THEN strftime(ts, '%Y-%m-%dT00:00:00') WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
        WHEN 'purchase' THEN strftime(ts, '%Y-%m-01T00:00:00') END AS at
    FROM events
""")
def _(spark, sf):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("+0230")))
        .when(kind == "view", F.date_format("ts", "'('yyyyMMdd')'")).when(kind == "signup", F.date_format("ts", "yyyyMMddHHmmss.SSSS"))
        .when(kind == "purchase", F.date_format("ts", "yyyyMM")).otherwise(F.date_format("ts", "yyyy'13'dd"))
    )
    return table(spark, sf, "events").select("event_id", sc.parse_hl7_dtm(raw).alias("at"))


@query("fn_8_yyyymmdd_to_iso", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '(not set)' WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y%m%d') || '07'
                            WHEN o_orderpriority = '5-LOW' THEN '20249931' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders
""")
def _(spark, sf):
    digits, urgency = F.date_format("o_orderdate", "yyyyMMdd"), F.col("o_orderpriority")
    odd = F.when(F.col("o_orderstatus") == "F", F.lit("(not set)")).when(urgency == "1-URGENT", F.concat(digits, F.lit("07"))).when(urgency == "5-LOW", F.lit("20249931"))
    raw = F.coalesce(odd, digits)
    return table(spark, sf, "orders").select("o_orderkey", sc.yyyymmdd_to_iso(raw).alias("day"))


@query("fn_9_metric_value", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linenumber END AS whole,
           CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS price, l_linestatus AS label FROM lineitem
""")
def _(spark, sf):
    item = table(spark, sf, "lineitem")
    bad = F.col("l_returnflag") == "A"
    whole = F.when(bad, F.lit("1.5")).otherwise(F.col("l_linenumber").cast("string"))
    price = F.when(bad, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string"))
    return item.select(
        "l_orderkey", "l_linenumber", sc.metric_value(whole, "TYPE_INTEGER").alias("whole"),
        sc.metric_value(price, "TYPE_CURRENCY").alias("price"), sc.metric_value(F.col("l_linestatus"), "TYPE_TEXT").alias("label"),
    )


ZONED = "CASE event_type WHEN 'click' THEN ts - INTERVAL 330 MINUTE WHEN 'view' THEN ts + INTERVAL 300 MINUTE WHEN 'error' THEN NULL ELSE ts END"


def _zoned():
    kind = F.col("event_type")
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (
        F.when(kind == "click", F.concat(base, F.lit("+05:30"))).when(kind == "view", F.concat(base, F.lit("-05:00")))
        .when(kind == "error", F.lit("yesterday")).when(kind == "signup", F.concat(base, F.lit("Z"))).otherwise(base)
    )


@query("fn_10_normalize_iso", f"SELECT event_id, CAST({ZONED} AS VARCHAR) AS at FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", sc.normalize_iso(_zoned()).cast("string").alias("at"))


@query("fn_11_cursor_gt", f"SELECT event_id, coalesce({ZONED} > TIMESTAMP '2024-01-15 12:00:00', false) AS newer FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", sc.cursor_gt(_zoned(), F.lit("2024-01-15T12:00:00Z")).alias("newer"))


@query("fn_12_shift_days", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'open' ELSE strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') END AS day,
           CAST(o_orderdate + INTERVAL 90 MINUTE AS VARCHAR) AS later FROM orders
""")
def _(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "F", F.lit("open")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, sf, "orders").select(
        "o_orderkey", sc.shift_days(raw, -1).alias("day"), sc.shift_minutes(F.col("o_orderdate"), 90).cast("string").alias("later")
    )


@query("fn_13_as_bool", "SELECT o_orderkey, o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' AS flag FROM orders")
def _(spark, sf):
    other = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1")).otherwise(F.lit("off"))
    word = F.when(F.col("o_orderstatus") == "O", F.lit(" YES ")).otherwise(other)
    return table(spark, sf, "orders").select("o_orderkey", sc.as_bool(word).alias("flag"))


@query("fn_13_as_bool_of_numbers", """
    SELECT event_id, event_id % 4 <> 0 AS whole, coalesce(value <> 0, false) AS real, event_id % 4 IN (1, 3) AS text FROM events
""")
def _(spark, sf):
    rest = F.col("event_id") % 4
    text = F.element_at(F.array(*[F.lit(x) for x in ("2", "T", "0.0", "y")]), (rest + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", sc.as_bool(rest).alias("whole"), sc.as_bool(F.col("value")).alias("real"), sc.as_bool(text).alias("text"))


@query("fn_14_try_numbers", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS as_float,
           CASE WHEN event_type IN ('view', 'click') THEN NULL WHEN event_type = 'error' THEN 1 ELSE event_id END AS as_int,
           CAST(event_id AS VARCHAR) AS as_text
    FROM events
""")
def _(spark, sf):
    kind = F.col("event_type")
    real = F.when(kind == "view", F.concat(F.col("value").cast("string"), F.lit("d"))).otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    whole = F.when(kind == "error", F.lit("true")).when(kind.isin("view", "click"), F.lit("12.0")).otherwise(F.col("event_id").cast("string"))
    return table(spark, sf, "events").select(
        "event_id", sc.try_float(real).alias("as_float"), sc.coerce_int(whole).alias("as_int"), sc.coerce_str(F.col("event_id")).alias("as_text")
    )


@query("fn_15_as_string_list", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderpriority || ',' || o_custkey WHEN 'O' THEN CAST(o_custkey AS VARCHAR) END AS items FROM orders
""")
def _(spark, sf):
    many = F.concat(F.lit('["'), F.col("o_orderpriority"), F.lit('",'), F.col("o_custkey").cast("string"), F.lit("]"))
    text = F.when(F.col("o_orderstatus") == "F", many).when(F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string")).otherwise("null")
    items = sc.as_string_list(F.try_parse_json(text))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(items, ",").alias("items"))


@query("fn_16_decode_binary", "SELECT doc_id, md5(CASE lang WHEN 'fr' THEN '~ ' || text ELSE text END) AS digest FROM documents")
def _(spark, sf):
    raw = F.encode("text", "UTF-8")
    coded = F.when(F.col("lang") == "en", F.base64(raw)).when(F.col("lang") == "fr", F.concat(F.lit("~ "), F.col("text"))).otherwise(
        F.concat(F.base64(raw))
    )
    return table(spark, sf, "documents").select("doc_id", F.md5(sc.decode_binary(F.replace(coded, F.lit("\r\n"), F.lit("")))).alias("digest"))


@query("fn_17_scrub_emails", r"""
    SELECT doc_id, md5(regexp_replace(text, '[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', 'redacted@example.com', 'g')) AS digest,
           contains(text, '@') AS had_at FROM documents
""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(sc.scrub_emails(F.col("text"))).alias("digest"), F.contains("text", F.lit("@")).alias("had_at"))


@query("fn_18_body_sha256", "SELECT doc_id, CASE WHEN lang = 'es' THEN NULL ELSE sha256(text) END AS digest FROM documents")
def _(spark, sf):
    body = F.when(F.col("lang") == "es", F.lit("")).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", sc.body_sha256(body).alias("digest"))


@query("fn_20_csv_to_list", """
    SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN p_type || '|' || p_brand ELSE replace(p_name, ' ', '|') END AS parts FROM part
""")
def _(spark, sf):
    listed = F.concat(F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(",,"))
    raw = F.when(F.col("p_type") == "ECONOMY", F.to_json(F.array("p_type", "p_brand"))).otherwise(listed)
    return table(spark, sf, "part").select("p_partkey", F.array_join(sc.csv_to_list(raw), "|").alias("parts"))


@query("fn_21_json_text", """
    SELECT s_suppkey, '{"name":"' || s_name || '","nation":' || s_nationkey || '}' AS body FROM supplier
""")
def _(spark, sf):
    one = F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return table(spark, sf, "supplier").select("s_suppkey", sc.json_text(one).alias("body"))


@query("fn_22_first_word_or_unknown", """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'Unknown' ELSE split_part(p_name, ' ', 1) END AS word FROM part
""")
def _(spark, sf):
    text = F.when(F.col("p_size") < 5, F.lit(None)).when(F.col("p_size") < 10, F.lit("  ")).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", sc.first_word_or_unknown(text).alias("word"))


@query("fn_23_url_parts", r"""
    SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) AS base, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
           nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages
""")
def _(spark, sf):
    params = sc.url_query(F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id", sc.url_base(F.col("url")).alias("base"), F.try_element_at(params, F.lit("page")).alias("page"),
        F.try_element_at(params, F.lit("ref")).alias("ref"),
    )


@query("fn_24_shape_of", """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'int' WHEN 'view' THEN 'float' WHEN 'error' THEN 'null' WHEN 'signup' THEN 'list' ELSE 'str' END AS shape,
           'dict' AS outer_shape FROM events
""")
def _(spark, sf):
    kind = F.col("event_type")
    inner = (
        F.when(kind == "click", F.col("user_id").cast("string")).when(kind == "view", F.concat((F.col("user_id")).cast("string"), F.lit(".5")))
        .when(kind == "error", F.lit("null")).when(kind == "signup", F.lit("[1]")).otherwise(F.lit('"x"'))
    )
    body = F.try_parse_json(F.concat(F.lit('{"v":'), inner, F.lit("}")))
    rows = table(spark, sf, "events").select("event_id", body.alias("b"))
    return rows.select("event_id", sc.shape_of(F.try_variant_get("b", "$.v", "variant")).alias("shape"), sc.shape_of(F.col("b")).alias("outer_shape"))


@query("fn_26_parse_multi_format_ts", """
    SELECT event_id, CAST(CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END AS VARCHAR) AS at FROM events
""")
def _(spark, sf):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(kind == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format("ts", "dd.MM.yyyy"))
    )
    return table(spark, sf, "events").select("event_id", sc.parse_multi_format_ts(raw).cast("string").alias("at"))


@query("fn_27_epoch_ms_fields", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS creation_date FROM orders")
def _(spark, sf):
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf, "orders").select("o_orderkey", sc.epoch_ms_field(ms).alias("creation_date"))


@query("prj_2_get_path", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS deep, NULL AS missing FROM events
""")
def _(spark, sf):
    body = F.try_parse_json(F.concat(F.lit('{"a": {"b": '), F.col("props"), F.lit("}}")))
    rows = table(spark, sf, "events").select("event_id", body.alias("v"))
    return rows.select("event_id", get_path(F.col("v"), "a.b.k").alias("deep"), get_path(F.col("v"), "a.b.k.z").alias("missing"))

"""Messages and records put together in tasks: spread over them, null rules, and templates as SQL chooses them."""

import pytest
from pyspark.sql import functions as F, types as T

from weirflow.functions.scalars import hl7_dtm_text, parse_hl7_dtm
from weirflow.operators import fhir, hl7
from weirflow.plans import segments
from weirflow.plans.catalogue import QUERIES
from weirflow.plans.texts import chosen, filler, replaced
from weirflow.session import spread


@pytest.fixture(scope="module")
def narrow(spark, tmp_path_factory):
    """Tables of one row group each, which a scan reads in one task."""
    at = tmp_path_factory.mktemp("narrow")
    spark.range(4000).select(
        F.col("id").alias("c_custkey"), F.lit("Customer").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment"),
    ).coalesce(1).write.parquet(f"{at}/customer.parquet")
    spark.range(4000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 999).alias("o_custkey"), (F.col("id") * 1.5).alias("o_totalprice"),
        F.lit("2024-01-02").cast("timestamp").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).coalesce(1).write.parquet(f"{at}/orders.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["fhir_1_encounter", "fhir_1_goal", "hl7_4_segment_txa", "hl7_4_segment_rxa"])
def test_one_row_group_is_read_by_all_cores(spark, narrow, name):
    got = QUERIES[name](spark, narrow)
    assert got.rdd.getNumPartitions() == 8


def test_spread_grows_with_the_rows(spark):
    rows = spark.range(0, 10_000, 1, 1)
    assert [spread(rows, n).rdd.getNumPartitions() for n in (20_000, 1000, 100)] == [8, 10, 100]
    assert spread(rows.limit(0)).count() == 0 and spread(rows.limit(7)).rdd.getNumPartitions() == 1
    assert spread(rows, 100).agg(F.sum("id")).first()[0] == sum(range(10_000))


def test_ways_are_those_of_sql(spark):
    ways = ["a", "b", "c", "d"]
    for n in (0, 1, 2, 3, 4, 7, -2, -3):
        got = spark.range(1).select(F.element_at(F.array(*map(F.lit, ways)), (F.lit(n) % 4 + 1).cast("int"))).first()[0]
        assert chosen(ways, n) == got


def test_texts_of_rows_with_nulls(spark, tmp_path):
    customers = [(None, "n", 1, "m"), (1, None, 1, "m"), (2, "n", None, "m"), (3, "n", 1, None), (4, "n", 1, "m")]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = QUERIES["fhir_1_goal"](spark, str(tmp_path)).collect()
    assert sorted((r["id"] or "") for r in got) == ["", "", "", "", "p4"]
    orders = [(None, 1, 2.0, "p", "2024-01-02"), (1, None, 2.0, "p", "2024-01-02"), (2, 1, None, "p", "2024-01-02"), (3, 1, 2.0, None, "2024-01-02"), (4, 1, 2.0, "p", None), (6, 1, 2.0, "p", "2024-01-02")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, d string").withColumn("o_orderdate", F.to_timestamp("d")).drop("d").write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES["hl7_4_segment_txa"](spark, str(tmp_path)).collect()
    assert sorted(r["message_id"] for r in found) == ["1", "6", "6"]
    assert chosen(["a", "b"], None) == "b"


def test_absent_lists_are_constants(spark):
    # An absent list used to be made by reading all its elements off the parent, doubled at every level.
    records = spark.createDataFrame([("{}",)], "raw_json string")
    plan = fhir.extract_resources(records, "Encounter", profile="base_r4").select("participant", "diagnosis", "location")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in text and plan.first() == ([], [], [])


def test_parts_of_a_text(spark):
    rows = spark.createDataFrame([("a&b&",), ("",), ("&x",), (None,), ("abc",)], "t string")
    got = rows.select(*[hl7._part(F.col("t"), "&", k) for k in (1, 2, 3, 4)]).collect()
    assert [tuple(r) for r in got] == [("a", "b", None, None), (None,) * 4, (None, "x", None, None), (None,) * 4, ("abc", None, None, None)]


def test_composites_are_cut_in_batches(spark, narrow):
    # Repetitions used to be read by higher-order functions, which Spark does not compile: 0.3 to 1.1 ms of CPU a message.
    plan = QUERIES["hl7_4_segment_nk1"](spark, narrow)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and plan.count("ArrowEvalPython") == 1


def test_separators_of_each_message_in_a_batch(spark):
    one = "MSH|^~\\&|A|B|C|D|20240101||ADT|1|P|2.5\rTXA|7||a^b&c|20240102|d1^F&G~~d2^H\\T\\I|||20240103~x~20240104||||e\\S\\1^n||f1^n~f2"
    two = one.replace("|", "#").replace("^", "$").replace("~", "%").replace("&", "*").replace("\\", "?").replace("ADT#1", "ADT#2")
    rows = spark.createDataFrame([(one,), (two,), (None,)], "message string").coalesce(1)
    got = {r["message_id"]: r for r in hl7.segment_table(hl7.parse_messages(rows), "txa").collect()}
    assert sorted(got) == ["1", "2"]
    for r in got.values():
        assert [(x["id"], x["given_name"]) for x in r["primary_activity_provider"]] == [("d1", None), ("d2", None)]
        assert (r["set_id"], r["activity_datetime"], r["edit_datetime"]) == (7, "2024-01-02T00:00:00", ["2024-01-03T00:00:00", "2024-01-04T00:00:00"])
        assert [x["entity_identifier"] for x in r["placer_order_number"]] == ["f1", "f2"]
        assert r["originator"] is None and r["document_type"] is None
    shown = {k: (r["document_content_presentation"], r["primary_activity_provider"][1]["family_name"], r["unique_document_number"]["entity_identifier"]) for k, r in got.items()}
    assert shown == {"1": ("a^b&c", "H\\T\\I", "e^1"), "2": ("a$b*c", "H?T?I", "e$1")}


def test_ways_shared_by_rows(spark):
    rows = [(k, c, p, "1-URGENT", "2024-01-02") for k in (1, 3, 7, 16, -4) for c in (None, -3, 0, 2, 5) for p in (-7.0, 0.0, 9.5, 123.0)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, d string").withColumn("o_orderdate", F.to_timestamp("d"))
    ways = [[f"{n}{w}" for w in "abcd"] for n in range(1, 10)]
    found = sorted(r["message"].split("\r")[1] for r in segments._messages(orders, "evn", ways).collect())
    away = lambda k, m: abs(k) % m * (1 if k >= 0 else -1)
    line = lambda k, c, p: "EVN|" + "|".join(chosen(w, None if c is None else c + n * away(k, 7) + n // 4 * away(int(p // 1), 11)) for n, w in enumerate(ways, 1))
    assert found == sorted(line(k, c, p) for k, c, p, *_ in rows)


def test_repetitions_join_without_broadcast(spark, tmp_path):
    # What Arrow batches give counts as next to nothing to Spark, so millions of reactions were broadcast; and AL1 was read twice.
    orders = [(k, 1, s, 1.5, "1-URGENT") for k, s in ((1, "P"), (2, "O"), (2, "P"), (3, "F"), (None, "P"))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").withColumn(
        "o_orderdate", F.lit("2024-01-02").cast("timestamp")).write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["hl7_7_rep_queries"](spark, str(tmp_path))
    plan = got._jdf.queryExecution()
    assert "Broadcast" not in plan.executedPlan().toString() and plan.optimizedPlan().toString().count("ArrowEvalPython") == 2
    ids = [r["message_id"] for r in got.collect()]
    assert [ids.count(x) for x in "123"] == [2, 8, 2] and len(ids) == 12
    assert {(r["code"], r["text"], r["citizenships"], r["has_race"]) for r in got.collect()} == {("HIV", "Hives", 2, True), ("RSH", "Rash", 2, True)}


@pytest.mark.parametrize("kind", ["obr", "in1", "pv1", "orc", "nk1", "sch", "gt1"])
def test_nested_columns_are_written_in_batches(spark, narrow, kind):
    # Hundreds of nested values a line used to become rows of Spark, to be written as JSON one by one.
    plan = QUERIES[f"hl7_4_segment_{kind}"](spark, narrow)._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "regexp_extract(pythonUDF" not in plan and plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("kind", ["obr", "in1", "pv1", "orc", "spm", "ft1", "msh", "rxa"])
def test_json_is_that_of_to_json(spark, kind):
    fields = [
        "", "7", "n/a", "a^b&c^^20240102", "^^", "~", "&", "^&x^&", "a&b&c&d&e&f&g&h&i&20240103^20240102", "x^y~~&z^~^^", "a\\T\\b^\\S\\&\\R\\c~\\F\\",
        '"q"^\x07\x02é\t\x1f😀~\\', "20240102101500+0130^2024^20241301~20240230", "^".join(f"c{i}" for i in range(30)), "&".join(f"s{i}" for i in range(30)),
        "~".join("^".join(f"2024010{i % 9 + 1}&{i}" for i in range(n)) for n in (1, 25, 3)),
    ]
    messages = []
    for n in range(len(fields)):
        lines = "|".join(fields[(i * 7 + n + i // 5) % len(fields)] for i in range(60))
        one = f"MSH|^~\\&|{lines if kind == 'msh' else 'A'}|B\r{kind.upper()}|{lines}"
        messages += [(one,), (one.translate(str.maketrans("|^~\\&", "#$%?*")),)]
    rows = hl7.parse_messages(spark.createDataFrame(messages, "message string").coalesce(1))
    plain, json = hl7.segment_table(rows, kind), hl7.segment_table(rows, kind, json=True)
    nested = lambda c: isinstance(plain.schema[c].dataType, (T.StructType, T.ArrayType))
    want = plain.select(*[F.to_json(c).alias(c) if nested(c) else c for c in plain.columns]).collect()
    got = json.collect()
    assert json.columns == plain.columns and len(got) == len(want) >= len(messages)
    for c in plain.columns:
        assert [r[c] for r in got] == [r[c] for r in want], c


def test_times_in_batches(spark):
    digits = ["2024", "202402", "20240229", "20230229", "2024013", "2024010124", "202401012359", "20240101235959", "20240101235960", "0000", "00010101", "99991231235959", ""]
    texts = [f"{a}{d}{f}{z}{b}" for d in digits for f in ("", ".5", ".") for z in ("", "+0000", "-0500", "+2359", "-2399", "+2400", "+050") for a, b in (("", ""), (" (", ") "), ("", "\u2028"), ("x", ""))]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_hl7_dtm(F.col("t")).alias("time")).collect()
    assert [(r["t"], r["time"]) for r in got if r["time"] != hl7_dtm_text(r["t"])] == [] and len({r["time"] for r in got}) > 25


def test_templates_filled(spark):
    marks = ["@K", "@P"]
    for text in ("", "@K", "a@K@Pb@K", "@P@@Kx", "no mark"):
        for values in ({"@K": "1", "@P": "x y"}, {"@K": "@P", "@P": "@K"}, {"@K": "", "@P": "@"}):
            assert filler(text, marks)(values) == replaced(text, values)

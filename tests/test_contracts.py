"""Specifications, contracts, options, schemas."""

import warnings

import pytest
from pyspark.sql import types as T

from weirflow.contracts import SpecError, TableContract, as_name_list, decode_option, resolve, validate_spec
from weirflow.functions import schemas as sm
from weirflow.functions.scalars import clamp_decimal, metric_type_name, report_header_name, safe_column_name_text, snake_name
from weirflow.operators import filters as fl, reports as rp


def spec(**table):
    return {"connection_name": "c", "objects": [{"table": {"source_table": "t", **table}}]}


@pytest.mark.parametrize("bad", [
    None, {}, {"connection_name": " ", "objects": []}, {"connection_name": "c", "objects": []}, {"connection_name": "c", "objects": [{}]},
    {"connection_name": "c", "objects": [{"table": {}}], "x": 1}, spec(unknown=1), spec(source_table=" "), spec(table_configuration={"scd_type": "SCD_TYPE_9"}),
])
def test_bad_specs(bad):
    with pytest.raises(SpecError):
        validate_spec(bad)


def test_plan():
    name, plans = validate_spec(spec(
        destination_catalog="a", destination_schema="b", destination_table="d",
        table_configuration={"scd_type": "scd_type_2", "primary_keys": ["x", "y"], "cluster_by": '["p", "q"]', "sequence_by": "s", "limit": 5, "opts": {"k": [1]}, "flag": True},
    ))
    plan = plans[0]
    assert name == "c" and plan.destination == "a.b.d" and plan.scd_type == "SCD_TYPE_2"
    assert plan.primary_keys == ("x", "y") and plan.cluster_by == ("p", "q") and plan.sequence_by == "s"
    assert plan.options == {"limit": "5", "opts": '{"k": [1]}', "flag": "true"}
    assert validate_spec(spec(destination_catalog="a", destination_table="d"))[1][0].destination == "d"


def test_resolve():
    contract = TableContract("t", ("k",), "c", "cdc")
    plan = validate_spec(spec())[1][0]
    full = resolve(plan, contract)
    assert (full.ingestion_type, full.scd_type, full.primary_keys, full.sequence_by) == ("cdc", "SCD_TYPE_1", ("k",), "c")
    forced = resolve(validate_spec(spec(table_configuration={"scd_type": "append_only"}))[1][0], contract)
    assert forced.ingestion_type == "append"
    with pytest.raises(SpecError):
        resolve(plan, None)
    keyed = resolve(validate_spec(spec(table_configuration={"primary_keys": "k", "sequence_by": "s"}))[1][0], None)
    assert keyed.ingestion_type == "cdc"


def test_names_and_options():
    assert as_name_list("a, b,,c") == ("a", "b", "c") and as_name_list('["a"]') == ("a",) and as_name_list("one") == ("one",) and as_name_list(None) == ()
    assert decode_option('["a"]', list) == ["a"] and decode_option(None, dict) == {}
    for text, kind in (("{}", list), ("nope", dict), ("[1]", dict)):
        with pytest.raises(SpecError):
            decode_option(text, kind)
    assert clamp_decimal(50, 60) == (38, 38) and clamp_decimal(None, None) == (38, 18) and clamp_decimal(10, 2) == (10, 2)
    assert [snake_name(n) for n in ("camelCase", "HTTPServer", "surveyId2Name")] == ["camel_case", "http_server", "survey_id2_name"]
    assert [safe_column_name_text(t, i) for i, t in enumerate(["a b", "  ", "__x--y__", None])] == ["a_b", "_col1", "x_y", "_col3"]
    assert report_header_name("Media Source") == "media_source"
    assert [metric_type_name(t) for t in ("TYPE_INTEGER", "TYPE_CURRENCY", "OTHER")] == ["bigint", "double", "string"]


def test_schemas():
    got = sm.schema_from_descriptors([{"name": "a", "type": "struct", "nullable": False, "fields": [{"name": "b", "type": "long"}]}])
    assert got == T.StructType([T.StructField("a", T.StructType([T.StructField("b", T.LongType())]), False)])
    assert sm.spark_type_of_edm("Edm.Int16") == T.LongType() and sm.spark_type_of_edm("Edm.New") == T.StringType()
    assert sm.ontology_type({"type": "array", "itemType": {"type": "struct", "properties": {"x": {"dataType": {"type": "double"}}}}}).simpleString() == "array<struct<x:double>>"
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert sm.ontology_type({"type": "marking"}) == T.StringType()
    assert seen
    assert sm.schema_from_ontology({"primaryKey": ["k"], "properties": {}}).simpleString() == "struct<k:string>"
    with pytest.raises(ValueError):
        sm.schema_from_ontology({})
    assert sm.infer_contract("e", ["lastModifiedOn", "lastModifiedDate"], ["k"]).cursor_field == "lastModifiedDate"
    assert sm.infer_contract("e", ["x"], ["k"]).ingestion_type == "snapshot"


def test_refusals(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert fl.where_ops(df, [("n", "gt", "x")]).count() == 0 and fl.where_ops(df, [("n", "ne", "x")]).count() == 0
    for call in (
        lambda: fl.tag_filters(df, "[]"), lambda: fl.tag_filters(df, '{"limit": 1}', ["limit"]), lambda: fl.tag_filters(df, '{"q": 1}'),
        lambda: fl.preview(df, 1, {"region": "text"}), lambda: fl.condition(df.schema, "n", "like", "1"), lambda: rp.preset("none"),
        lambda: rp.report(df, ["x"], [], {}, {}, "n"), lambda: rp.report(df, ["s"] * 10, [], {"s": None}, {}, "n"),
    ):
        with pytest.raises(SpecError):
            call()

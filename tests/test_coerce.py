"""Type rules case by case: raw JSON value, type, result or error."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from weirflow.functions.coerce import coerce

ERROR = object()

CASES = [
    ("text", "string", "text"), (12, "string", "12"), ("12", "int", 12), ("1.9", "int", 1), ("-1.9", "bigint", -1), (1.9, "int", 1), (" 7 ", "bigint", 7),
    ("", "int", ERROR), ("abc", "bigint", ERROR), (True, "int", 1), (None, "int", None),
    ("1e3", "double", 1000.0), (3, "double", 3.0), ("x", "double", ERROR), ("1d", "double", ERROR),
    ("12.345", "decimal(10,3)", Decimal("12.345")), (7, "decimal(4,1)", Decimal("7.0")), ("x", "decimal(4,1)", ERROR),
    ("TRUE", "boolean", True), ("y", "boolean", True), ("1", "boolean", True), ("No", "boolean", False), ("f", "boolean", False), ("0", "boolean", False),
    ("maybe", "boolean", True), ("", "boolean", False), (0, "boolean", False), (5, "boolean", True), (False, "boolean", False),
    ("2024-02-29", "date", dt.date(2024, 2, 29)), ("02/29/2024", "date", dt.date(2024, 2, 29)), ("29-02-2024", "date", dt.date(2024, 2, 29)),
    ("2024/2/9", "date", dt.date(2024, 2, 9)), ("2024-01-05T10:00:00", "date", dt.date(2024, 1, 5)), ("2023-02-29", "date", ERROR), (5, "date", ERROR),
    ("2024-01-05T10:00:00Z", "timestamp", "2024-01-05 10:00:00"), ("2024-01-05T10:00:00+02:00", "timestamp", "2024-01-05 08:00:00"),
    ("2024-01-05 10:00:00", "timestamp", "2024-01-05 10:00:00"), ("2024/01/05 10:00:00", "timestamp", "2024-01-05 10:00:00"),
    (1700000000, "timestamp", "2023-11-14 22:13:20"), (1700000000.5, "timestamp", "2023-11-14 22:13:20.5"), ("soon", "timestamp", ERROR),
    ("AQI=", "binary", b"\x01\x02"), ("0aff", "binary", None), ("~ plain", "binary", b"~ plain"), ([1, 255], "binary", b"\x01\xff"),
    (["1", 2, None], "array<int>", [1, 2, None]), ("5", "array<int>", [5]), (["x"], "array<int>", ERROR), ([], "array<string>", []),
    ({"a": "1", "b": 2}, "map<string,int>", {"a": 1, "b": 2}), ({"1": "x"}, "map<int,string>", {1: "x"}), ([1], "map<string,int>", ERROR),
    ({"x": "1"}, "struct<x:int,y:string>", {"x": 1, "y": None}), ({}, "struct<x:int>", ERROR), ("s", "struct<x:int>", ERROR),
    ({"z": 1}, "struct<x:int>", {"x": None}), ({"x": {"y": ["1"]}}, "struct<x:struct<y:array<bigint>>>", {"x": {"y": [1]}}),
    ([{"x": "1"}, {"x": 2}], "array<struct<x:int>>", [{"x": 1}, {"x": 2}]), ([{}], "array<struct<x:int>>", ERROR),
    ({"x": 1}, "struct<x:int not null>", {"x": 1}), ({"y": 1}, "struct<x:int not null,y:int>", ERROR),
]


def plain(value):
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def run(spark, raw, kind, mode):
    df = spark.createDataFrame([(json.dumps({"c": raw, "other": 1}),)], "j string")
    out = coerce(df, "j", f"c {kind}, other int", mode)
    if kind == "timestamp":
        out = out.selectExpr("cast(c as string) as c")
    return plain(out.head()["c"])


@pytest.mark.parametrize("raw,kind,want", CASES)
def test_rule(spark, raw, kind, want):
    if want is ERROR:
        with pytest.raises(Exception, match="cannot convert"):
            run(spark, raw, kind, "strict")
        got = run(spark, raw, kind, "lenient")
        assert got is None or got == [None] or got == {"x": None, "y": 1}
    elif raw == "0aff":
        # Four letters of the base64 alphabet: base64 is tried first.
        assert run(spark, raw, kind, "strict") == b"\xd1\xa7\xdf"
    else:
        assert run(spark, raw, kind, "strict") == want
        assert run(spark, raw, kind, "lenient") == want


def test_text_that_is_no_json(spark):
    df = spark.createDataFrame([("{broken",)], "j string")
    assert coerce(df, "j", "c int").head()["c"] is None
    with pytest.raises(Exception):
        coerce(df, "j", "c int", "strict").collect()


def test_variant(spark):
    df = spark.createDataFrame([('{"c": "{\\"a\\": 1}"}',), ('{"c": {"a": 1}}',)], "j string")
    got = coerce(df, "j", "c variant").selectExpr("variant_get(c, '$.a', 'int') as a").collect()
    assert [r["a"] for r in got] == [1, 1]

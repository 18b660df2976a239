"""Selection of the n-th key against sorting, over many passes and with many ties."""

import random

import pytest
from pyspark.sql import functions as F

from weirflow.operators import selection
from weirflow.operators.filters import slice_page
from weirflow.sources import incremental as inc


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(selection, "FEW", 5)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    return [(rng.choice([None, 1.5, -2.25, 7.0] + [rng.random() * 100] * 4), rng.choice(["x", None, "y" * 30, str(rng.randrange(40))]), i) for i in range(900)]


def key(row):
    return [(v is not None, 0 if v is None else v) if not isinstance(v, str) else (True, v) for v in row]


@pytest.mark.parametrize("n", [1, 2, 17, 450, 899, 900, 901])
def test_nth_of_mixed_keys(spark, data, few, n):
    df = spark.createDataFrame(data, "a double, b string, i int")
    line = sorted(data, key=lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or "")))
    got = selection.nth_key(df, ["a", "b"], n)
    want = None if n > len(line) else line[n - 1][:2]
    assert (got and [got[0] and float(got[0]), got[1]]) == (want and [want[0] and float(want[0]), want[1]])


def test_nth_among_ties(spark, few):
    df = spark.range(4000).select(F.when(F.col("id") < 3990, 1).otherwise(F.col("id")).alias("v"))
    assert [selection.nth_key(df, ["v"], n) for n in (1, 3990, 3991, 4000, 4001)] == [["1"], ["1"], ["3990"], ["3999"], None]
    two = spark.range(300).select((F.col("id") == 299).cast("int").alias("v"))
    assert [selection.nth_key(two, ["v"], n) for n in (299, 300)] == [["0"], ["1"]]


def test_budget_larger_than_a_partition(spark, few):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") % 1250).cast("timestamp").cast("timestamp_ntz").alias("ts"), "id")
    rows, end = inc.admit_batch(df, "ts", 3001)
    assert rows.count() == 3004 and end["cursor"] == "1970-01-01 00:12:30"
    batch, end = inc.keyset_scan(df, "ts", "id", None, 3001)
    assert batch.count() == 3001 and end == {"cursor": "1970-01-01 00:12:30", "tiebreak": "750"}
    rows, end, more = inc.limit_plus_one(df, "ts", "id", 4999)
    assert more and rows.count() == 4999
    assert [r["id"] for r in slice_page(df, ["ts", "id"], 2000, 1000).collect()] == [r["id"] for r in df.orderBy("ts", "id").offset(2000).limit(1000).collect()]
    assert slice_page(df, ["id"], 4990, 100).count() == 10 and slice_page(df, ["id"], 5000, 1).count() == 0 and slice_page(df, ["id"], -3, 2).count() == 2
    for frame in (rows, batch, slice_page(df, ["id"], 10, 4000)):
        assert "TakeOrdered" not in frame._jdf.queryExecution().executedPlan().toString()

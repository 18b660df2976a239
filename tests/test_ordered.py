"""Chunked neighbour steps against plain Python, with one key that holds half of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from weirflow.operators.ordered import CHUNK, lay_out, with_fill, with_neighbour, with_position, with_running


def rows(n=600, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        out.append((key, rng.randint(0, 200), i, None if rng.random() < 0.4 else rng.randint(1, 99)))
    return out


def lines(data):
    by = {}
    for r in data:
        by.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in by.items()}


@pytest.fixture
def df(spark):
    return spark.createDataFrame(rows(), "k string, t int, i int, v int")


def test_chunks_bound_a_hot_key(df, small_chunks):
    sizes = lay_out(df, ["k"], ["t", "i"]).groupBy("k", CHUNK).count().collect()
    assert max(r["count"] for r in sizes) < 100
    assert sum(r["k"] == "hot" for r in sizes) > 5


@pytest.mark.parametrize("ahead", [True, False])
def test_neighbour(df, small_chunks, ahead):
    got = {r["i"]: r["w"] for r in with_neighbour(df, ["k"], ["t", "i"], {"w": F.col("i")}, ahead).collect()}
    want = {}
    for line in lines(rows()).values():
        for a, b in zip(line, line[1:]):
            want[a[2] if ahead else b[2]] = b[2] if ahead else a[2]
    assert got == {r[2]: want.get(r[2]) for r in rows()}


@pytest.mark.parametrize("ahead", [True, False])
def test_fill(df, small_chunks, ahead):
    got = {r["i"]: r["w"] for r in with_fill(df, ["k"], ["t", "i"], {"w": F.col("v")}, ahead).collect()}
    want = {}
    for line in lines(rows()).values():
        last = None
        for r in reversed(line) if ahead else line:
            last = r[3] if r[3] is not None else last
            want[r[2]] = last
    assert got == want


def test_running_and_position(df, small_chunks):
    got = {r["i"]: (r["s"], r["p"]) for r in with_position(
        with_running(df, ["k"], ["t", "i"], {"s": F.coalesce("v", F.lit(0))}), ["k"], ["t", "i"], "p").collect()}
    want = {}
    for line in lines(rows()).values():
        total = 0
        for p, r in enumerate(line, 1):
            total += r[3] or 0
            want[r[2]] = (total, p)
    assert got == want


def test_equal_heads_are_split(spark, small_chunks):
    data = [("k", 7, f"the-same-long-prefix-{i:05d}") for i in range(400)]
    df = spark.createDataFrame(data, "k string, t int, name string")
    for order in (["name"], ["t", "name"]):
        sizes = [r["count"] for r in lay_out(df, ["k"], order).groupBy(CHUNK).count().collect()]
        assert len(sizes) > 5 and max(sizes) < 120
        assert [r["p"] for r in with_position(df, ["k"], order, "p").orderBy("name").collect()] == list(range(1, 401))


def test_null_and_decimal_order(spark, small_chunks):
    data = [(None if i % 50 == 0 else f"{i % 37}.{i % 10}", i) for i in range(300)]
    df = spark.createDataFrame(data, "d string, i int").select(F.col("d").cast("decimal(10,2)"), "i")
    placed = with_position(df, [], ["d", "i"], "p").orderBy("d", "i").collect()
    assert [r["p"] for r in placed] == list(range(1, 301))


def test_order_by_text_and_time(spark, small_chunks):
    data = [("k", f"{i % 97:03d}-{i:04d}") for i in range(300)]
    df = spark.createDataFrame(data, "k string, t string")
    got = [r["p"] for r in with_position(df, ["k"], ["t"], "p").orderBy("t").collect()]
    assert got == list(range(1, 301))
    stamps = df.select("k", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.pmod(F.xxhash64("t"), F.lit(5000)).cast("int"))).alias("ts"), "t")
    placed = with_position(stamps, ["k"], ["ts", "t"], "p").orderBy("ts", "t").collect()
    assert [r["p"] for r in placed] == list(range(1, 301))


def test_steps_over_one_layout(spark, df, small_chunks):
    """Rows filtered away between steps may empty whole chunks, also those in the middle of a key."""
    laid = lay_out(df, ["k"], ["t", "i"])
    some = with_neighbour(laid.filter("t < 20 OR t > 180"), ["k"], ["t", "i"], {"w": F.col("i")})
    got = {r["i"]: (r["w"], r["s"]) for r in with_running(some, ["k"], ["t", "i"], {"s": F.lit(1)}).collect()}
    want = {}
    for line in lines([r for r in rows() if r[1] < 20 or r[1] > 180]).values():
        for n, (a, b) in enumerate(zip(line, [*line[1:], None]), 1):
            want[a[2]] = (b and b[2], n)
    assert got == want

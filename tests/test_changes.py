"""Change application: order, ties, deletes, late rows, repeats; written tables and streams."""

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from weirflow.operators import changes as ch
from weirflow.session import fresh_path
from weirflow.streaming import landing as st


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, seq int")


def gone(spark, rows):
    return spark.createDataFrame(rows, "k string, seq int")


def state(df):
    return {r["k"]: (r["v"], r["seq"]) for r in ch.visible(df).collect()}


def test_scd1_order_and_ties(spark):
    first = ch.scd1(None, frame(spark, [("a", "2", 2), ("a", "1", 1), ("b", "x", 5), (None, "n", 1)]), ["k"], ["seq"])
    assert state(first) == {"a": ("2", 2), "b": ("x", 5), None: ("n", 1)}
    # An older update is ignored, an equal delete wins, a delete of something unknown is kept.
    second = ch.scd1(first, frame(spark, [("a", "0", 0), ("b", "y", 6)]), ["k"], ["seq"], gone(spark, [("b", 6), ("z", 9)]))
    assert state(second) == {"a": ("2", 2), None: ("n", 1)}
    # A late upsert older than the delete stays deleted, a newer one revives.
    third = ch.scd1(second, frame(spark, [("z", "late", 8), ("b", "back", 7)]), ["k"], ["seq"])
    assert state(third) == {"a": ("2", 2), "b": ("back", 7), None: ("n", 1)}
    again = ch.scd1(third, frame(spark, [("z", "late", 8), ("b", "back", 7)]), ["k"], ["seq"])
    assert state(again) == state(third)


def history(df):
    rows = ch.visible(df) if ch.DELETED in df.columns else df
    return sorted((r["k"], r["v"], r[ch.START], r[ch.END]) for r in rows.collect())


CHANGES = [("a", "1", 1), ("a", "1", 2), ("a", "2", 5), ("a", "2", 9), ("b", "x", 3), ("b", None, 4), ("c", "q", 1)]
DELETES = [("a", 7), ("a", 8), ("c", 1)]
WANT = [("a", "1", 1, 5), ("a", "2", 5, 7), ("a", "2", 9, None), ("b", None, 4, None), ("b", "x", 3, 4)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(str(x) for x in r))


def test_scd2(spark):
    got = ch.scd2(frame(spark, CHANGES), ["k"], "seq", gone(spark, DELETES))
    rows = [(r["k"], r["v"], r[ch.START], r[ch.END]) for r in got.collect()]
    assert ordered(rows) == ordered(WANT)


@pytest.mark.parametrize("late", [[0], [1, 3], [2], [3, 4, 5], [6, 0, 2]])
def test_scd2_late_rows_give_the_same_history(spark, late):
    early = [c for i, c in enumerate(CHANGES) if i not in late]
    first = ch.scd2_state(frame(spark, early), ["k"], "seq", gone(spark, DELETES[:1]))
    after = ch.scd2_apply(first, frame(spark, [CHANGES[i] for i in late]), ["k"], "seq", gone(spark, DELETES[1:]))
    rows = [(r["k"], r["v"], r[ch.START], r[ch.END]) for r in ch.visible(after).collect()]
    assert ordered(rows) == ordered(WANT)


def test_scd2_in_chunks(spark, small_chunks):
    rows = [("hot", str(i // 3 % 4), i) for i in range(300)] + [(f"k{i}", "v", i) for i in range(100)]
    got = ch.scd2(frame(spark, rows), ["k"], "seq").filter("k = 'hot'").collect()
    assert sorted((r["v"], r[ch.START], r[ch.END]) for r in got) == sorted(
        (str(i // 3 % 4), i, i + 3 if i + 3 < 300 else None) for i in range(0, 300, 3)
    )


def test_snapshot(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 4), ("d", 4)], "k string, v int")
    now, counts = ch.snapshot_scd1(old, new, ["k"])
    assert sorted((r["k"], r["v"] or 0) for r in now.collect()) == [("a", 1), ("b", 3), ("c", 0), ("d", 4)]
    assert {r["_change"]: r["n"] for r in counts.collect()} == {"same": 2, "update": 1, "insert": 1}
    hist = old.select("k", "v", F.lit(1).alias(ch.START), F.lit(None).cast("int").alias(ch.END))
    second = ch.snapshot_scd2(hist, new.filter("k <> 'a'"), ["k"], F.lit(2))
    rows = {(r["k"], r["v"], r[ch.START], r[ch.END]) for r in second.collect()}
    assert rows == {("a", 1, 1, 2), ("b", 2, 1, 2), ("b", 3, 2, None), ("c", None, 1, None), ("d", 4, 2, None)}
    third = ch.snapshot_scd2(second, new, ["k"], F.lit(3))
    assert ("a", 1, 3, None) in {(r["k"], r["v"], r[ch.START], r[ch.END]) for r in third.collect()}


def test_versions_are_replayed_once(spark):
    store = ch.VersionedTable(spark, fresh_path(spark, "t"))
    assert store.read() is None and store.version() is None
    assert store.replace(frame(spark, [("a", "1", 1)]), 0) and not store.replace(frame(spark, [("z", "9", 9)]), 0)
    assert [r["k"] for r in store.read().collect()] == ["a"]
    assert store.replace(ch.append(store.read(), frame(spark, [("b", "1", 1)])), 1, ["k"])
    assert sorted(r["k"] for r in store.read().collect()) == ["a", "b"]


def test_upsert_table_replay(spark):
    target = st.UpsertTable(spark, fresh_path(spark, "u"), ["k"], ["seq"], compact_every=2)
    batches = [frame(spark, [("a", str(i), i), (f"k{i}", "x", i)]) for i in range(5)]
    for i, b in enumerate(batches):
        target.apply(b, i)
        target.apply(b, i)  # the same batch again after a failure
    got = {r["k"]: r["v"] for r in target.read().collect()}
    assert got == {"a": "4", **{f"k{i}": "x" for i in range(5)}}
    assert target.base.version() == 3


def test_clustered_files_are_sorted(spark):
    path = fresh_path(spark, "c")
    rows = spark.range(1000).select((F.xxhash64("id") % 1000).alias("x"), "id")
    ch.write_clustered(rows, path, ["x"], 4)
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("x").alias("a"), F.max("x").alias("b")).orderBy("a").collect()
    assert len(spans) == 4 and all(p["b"] <= q["a"] for p, q in zip(spans, spans[1:]))


def test_blobs(spark, tmp_path):
    df = spark.createDataFrame([("a/b/1", b"x"), ("a/2", b""), ("../no", b"y"), ("a/3", None)], "p string, d binary")
    got = {r["p"]: r["written_path"] for r in ch.write_blobs(df, str(tmp_path), "p", "d").collect()}
    assert got["../no"] is None and got["a/3"] is None and open(got["a/b/1"], "rb").read() == b"x"


def test_blobs_keep_the_scheme(spark, tmp_path):
    df = spark.createDataFrame([(1, "a/1", b"x" * 3), (2, "/b", b"\xff\x00"), (3, None, b"z"), (4, "", b"z"), (5, "a/1", b"xxx")], "n int, p string, d binary")
    for _ in range(2):  # a repeated run leaves the same files
        got = {r["n"]: r["written_path"] for r in ch.write_blobs(df, f"file://{tmp_path}/out/", "p", "d").collect()}
        assert got == {1: f"file://{tmp_path}/out/a/1", 2: f"file://{tmp_path}/out/b", 3: None, 4: None, 5: f"file://{tmp_path}/out/a/1"}
        stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"file://{tmp_path}/out")
        assert sorted(bytes(r["content"]) for r in stored.collect()) == [b"xxx", b"\xff\x00"]
    assert ch.write_blobs(df.limit(0), str(tmp_path), "p", "d").columns == ["n", "p", "written_path"]


def test_blobs_that_cannot_be_written_fail(spark, tmp_path):
    (tmp_path / "taken").write_bytes(b"a file where a folder is wanted")
    df = spark.createDataFrame([("taken/1", b"x")], "p string, d binary")
    with pytest.raises(PythonException):
        ch.write_blobs(df, str(tmp_path), "p", "d").collect()

"""Landing a specification: what earlier runs wrote stays, repeats go, compaction empties what it holds."""

from pathlib import Path

from pyspark.errors import StreamingQueryException
from pyspark.sql.functions import col, when

from weirflow.contracts import TableContract, resolve, validate_spec
from weirflow.operators.changes import VersionedTable, scd2
from weirflow.streaming.landing import UpsertTable, land_table, stream_files, watermark_stream


def plan(name, contract, **config):
    spec = {"connection_name": "c", "objects": [{"table": {"source_table": name, "table_configuration": config}}]}
    return resolve(validate_spec(spec)[1][0], contract)


def files(root):
    return {str(p): p.read_bytes() for p in Path(root).rglob("part-*")}


def test_append_adds_files(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    append = plan("t", TableContract("t", (), None, "append"))
    land_table(spark, append, lambda: (rows, None), str(tmp_path), 0)
    before = files(tmp_path)
    for _ in range(2):  # a run that is repeated writes its own folder again
        got = land_table(spark, append, lambda: (rows.selectExpr("id + 10 AS id", "'x' AS more"), None), str(tmp_path), 1)
    assert {k: v for k, v in files(tmp_path).items() if k in before} == before
    assert sorted((r.id, r.more) for r in got.collect()) == [(1, None), (1, None), (2, None), (11, "x"), (11, "x"), (12, "x")]


def test_first_snapshot_has_one_row_per_key(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    for i, config in enumerate(({}, {"scd_type": "SCD_TYPE_2"})):
        snap = plan("t", TableContract("t", ("id",), None, "snapshot"), **config)
        for run in (0, 1):
            assert sorted(r.id for r in land_table(spark, snap, lambda: (rows, None), str(tmp_path / str(i)), run).collect()) == [1, 2]


def test_compaction_empties_old_frames(spark, tmp_path):
    target = UpsertTable(spark, str(tmp_path / "t"), ["id"], ["at"], compact_every=2)
    for n in range(5):
        target.apply(spark.createDataFrame([(1, n, f"v{n}"), (10 + n, n, "new")], "id int, at int, v string"), n)
        assert {r.id: r.v for r in target.read().collect()} == {1: f"v{n}", **{10 + i: "new" for i in range(n + 1)}}
    left = spark.read.option("basePath", str(tmp_path / "t/delta")).parquet(str(tmp_path / "t/delta"))
    assert {r["_batch"] for r in left.select("_batch").distinct().collect()} == {4}


def test_history_rewrites_touched_buckets_only(spark, tmp_path):
    hist = plan("t", TableContract("t", ("id",), "at", "cdc_with_deletes"), scd_type="SCD_TYPE_2")
    rows = spark.createDataFrame([(i, 1, "a") for i in range(300)], "id int, at int, v string")
    none = rows.limit(0).select("id", "at")
    land_table(spark, hist, lambda: (rows, none), str(tmp_path), 0)
    before = files(tmp_path)
    late = spark.createDataFrame([(7, 3, "c"), (7, 2, "b")], "id int, at int, v string")
    gone = spark.createDataFrame([(8, 5)], "id int, at int")
    got = land_table(spark, hist, lambda: (late, gone), str(tmp_path), 1)
    after = files(tmp_path)
    assert {k: v for k, v in after.items() if k in before} == before
    assert len({k.split("_bucket=")[1].split("/")[0] for k in after if "/v=1/" in k}) == 2
    mine = {(r.id, r.v, r["__START_AT"], r["__END_AT"]) for r in got.filter("id in (7, 8)").collect()}
    assert mine == {(7, "a", 1, 2), (7, "b", 2, 3), (7, "c", 3, None), (8, "a", 1, 5)}
    assert got.count() == 302
    # Landed in one go it is the same history.
    whole = scd2(rows.unionByName(late), ["id"], "at", gone)
    assert whole.select(*got.columns).exceptAll(got).isEmpty() and got.exceptAll(whole.select(*got.columns)).isEmpty()


def test_snapshots_rewrite_changed_buckets_only(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a") for i in range(300)], "id int, v string")
    for name, config in (("one", {}), ("two", {"scd_type": "SCD_TYPE_2"})):
        snap, root = plan("t", TableContract("t", ("id",), None, "snapshot"), **config), tmp_path / name
        land_table(spark, snap, lambda: (rows, None), str(root), 0)
        before = files(root)
        land_table(spark, snap, lambda: (rows, None), str(root), 1)  # nothing changed, nothing written
        assert files(root) == before
        moved = rows.filter("id <> 3").withColumn("v", when(col("id") == 4, "b").otherwise(col("v")))
        got = land_table(spark, snap, lambda: (moved, None), str(root), 2)
        after = files(root)
        assert {k: v for k, v in after.items() if k in before} == before
        assert len({k.split("_bucket=")[1].split("/")[0] for k in after if "/v=2/" in k}) <= 2
        if config:
            assert {(r.id, r.v, r["__START_AT"], r["__END_AT"]) for r in got.filter("id in (3, 4)").collect()} == {(3, "a", 0, 2), (4, "a", 0, 2), (4, "b", 2, None)}
        else:
            assert sorted((r.id, r.v) for r in got.filter("id < 6").collect()) == [(0, "a"), (1, "a"), (2, "a"), (4, "b"), (5, "a")]


def test_a_bucket_can_become_empty(spark, tmp_path):
    store = VersionedTable(spark, str(tmp_path / "t"), ["id"], buckets=4)
    rows = spark.range(40).select(col("id"), col("id").alias("v"))
    store.replace(rows, 0)
    touched = store.touched(rows.filter("id = 5"))
    assert len(touched) == 1
    store.replace(store.read(touched).limit(0), 1, only=touched)
    left = {r.id for r in store.read().collect()}
    assert left == {r.id for r in rows.exceptAll(store.within(rows, touched)).collect()} and 5 not in left
    # The number of buckets stays that of the first version.
    assert VersionedTable(spark, str(tmp_path / "t"), ["id"], buckets=9).touched(rows.filter("id = 5")) == touched
    store.replace(rows.limit(0), 2)
    assert store.read().count() == 0 and store.read().columns == ["id", "v"]


def test_watermarks_of_a_repeated_batch(spark, tmp_path):
    marks = UpsertTable(spark, str(tmp_path / "m"), ["k"], ["watermark", "token"], compact_every=3)
    kind = "k string, at int, no int"
    parts = [[("a", 1, 1), ("a", 1, 2), ("b", 5, 1)], [("a", 1, 2), ("a", 1, 3), ("b", 4, 9), (None, 1, 1)], [("a", 0, 9), ("b", 6, 0), (None, 1, 1), (None, 1, 2)]]
    landed = {}

    def land(fresh, number):
        got = sorted(map(tuple, fresh.collect()), key=str)
        if fail.pop(number, None):
            raise ValueError("lost after landing")
        assert landed.setdefault(number, got) == got

    fail = {1: True}
    for n, part in enumerate(parts):
        spark.createDataFrame(part, kind).coalesce(1).write.parquet(str(tmp_path / f"in/p{n}"))
        for _ in range(2):
            try:
                watermark_stream(stream_files(spark, str(tmp_path / "in/*"), spark.createDataFrame([], kind).schema), ["k"], "at", marks, land, str(tmp_path / "cp"), "no")
            except StreamingQueryException:
                continue
    assert landed == {0: sorted(parts[0], key=str), 1: sorted([("a", 1, 3), (None, 1, 1)], key=str), 2: sorted([("b", 6, 0), (None, 1, 2)], key=str)}
    assert {r.k: (r.watermark, r.token) for r in marks.read().collect()} == {"a": (1, 3), "b": (6, 0), None: (1, 2)}

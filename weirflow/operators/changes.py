"""Change application: append, keyed upserts, deletes, history and snapshot differences.

State frames carry ``_deleted``: a removed key stays as a marked row so that a late, older change
does not bring it back. :func:`visible` hides marked rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.operators.keys import join_on
from weirflow.operators.ordered import CHUNK, lay_out, with_neighbour

START, END, DELETED, REPEAT = "__START_AT", "__END_AT", "_deleted", "_repeat"


def append(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Every row lands."""
    return batch if target is None else target.unionByName(batch, allowMissingColumns=True)


def _tagged(df: DataFrame, deleted: bool) -> DataFrame:
    return df if DELETED in df.columns else df.withColumn(DELETED, F.lit(deleted))


def scd1(
    target: DataFrame | None,
    batch: DataFrame | None,
    keys: Sequence[str],
    seq: Sequence[str],
    deletes: DataFrame | None = None,
) -> DataFrame:
    """Per key the row with the highest ``seq``, out of the target, the batch and the tombstones.

    One aggregation with map-side combine and no window, so a key with very many changes costs no
    more than any other. At equal ``seq`` a delete wins, then the larger row hash.
    """
    parts = [_tagged(p, False) for p in (target, batch) if p is not None]
    if deletes is not None:
        parts.append(_tagged(deletes, True))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    body = [c for c in rows.columns if c not in keys]
    rank = F.struct(*[F.col(s).alias(f"s{i}") for i, s in enumerate(seq)], F.col(DELETED), F.xxhash64(*body).alias("h"))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*body), rank).alias("_best"))
    return best.select(*keys, "_best.*")


def visible(state: DataFrame) -> DataFrame:
    shown = state.filter(~F.col(DELETED))
    return (shown.filter(~F.col(REPEAT)) if REPEAT in state.columns else shown).drop(DELETED, REPEAT)


def _tagged_changes(changes: DataFrame, deletes: DataFrame | None) -> DataFrame:
    rows = _tagged(changes, False)
    return rows if deletes is None else rows.unionByName(_tagged(deletes, True), allowMissingColumns=True)


def _versions(changes: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """All change rows with ``__START_AT``, ``__END_AT`` and two marks: a delete, and a repeat of the
    version before it. Marked rows are no versions, but a late change may need them."""
    body = [c for c in changes.columns if c not in (*keys, seq, DELETED)]
    rank = F.struct(F.col(DELETED), F.xxhash64(*body).alias("h"))
    one = changes.groupBy(*keys, seq).agg(F.max_by(F.struct(*body, DELETED), rank).alias("_b"))
    one = lay_out(one.select(*keys, seq, "_b.*"), keys, [seq])
    marked = with_neighbour(one, keys, [seq], {
        "_prev": F.struct(F.col(DELETED).alias("d"), F.when(~F.col(DELETED), F.struct(*body)).alias("b")),
    }, ahead=False)
    same = F.col("_prev").isNotNull() & (F.col("_prev.d") == F.col(DELETED)) & (
        F.col(DELETED) | F.col("_prev.b").eqNullSafe(F.struct(*body))
    )
    marked = marked.select(*keys, seq, *body, DELETED, same.alias(REPEAT), CHUNK)
    closed = with_neighbour(marked.filter(~F.col(REPEAT)), keys, [seq], {END: F.col(seq)}, ahead=True)
    repeats = marked.filter(REPEAT).withColumn(END, F.lit(None).cast(marked.schema[seq].dataType))
    rows = closed.unionByName(repeats)
    return rows.select(*keys, *body, F.col(seq).alias(START), END, DELETED, REPEAT)


def scd2_state(changes: DataFrame, keys: Sequence[str], seq: str, deletes: DataFrame | None = None) -> DataFrame:
    """History as kept on disk: versions, and marked deletes and repeats."""
    return _versions(_tagged_changes(changes, deletes), keys, seq)


def scd2(changes: DataFrame, keys: Sequence[str], seq: str, deletes: DataFrame | None = None) -> DataFrame:
    """One row per version: ``__START_AT`` is its ``seq``, ``__END_AT`` the next one's (null: current).

    A tombstone closes the open version and gives no row; equal neighbours count as one version.
    """
    return visible(scd2_state(changes, keys, seq, deletes))


def scd2_apply(
    state: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str, deletes: DataFrame | None = None
) -> DataFrame:
    """Merge changes, late ones too, into a kept history: only touched keys are built anew."""
    rows = _tagged_changes(changes, deletes)
    touched = rows.select(*keys).distinct()
    old = join_on(state, touched, keys, "left_semi").drop(END, REPEAT).withColumnRenamed(START, seq)
    both = rows.unionByName(old, allowMissingColumns=True)
    rebuilt = _versions(both, keys, seq)
    return join_on(state, touched, keys, "left_anti").unionByName(rebuilt.select(*state.columns))


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, that with the largest row hash."""
    body = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*body), F.xxhash64(*body)).alias("_b")).select(*keys, "_b.*")


def snapshot_diff(target: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key ``_change`` (insert, update, delete, same) with both rows as ``_old`` and ``_new``."""
    snap = one_per_key(snapshot, keys)
    body = [c for c in snap.columns if c not in keys]
    left = target.select(*[F.col(k).alias(f"_l{i}") for i, k in enumerate(keys)], F.struct(*body).alias("_old"), F.lit(True).alias("_in_old"))
    right = snap.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], F.struct(*body).alias("_new"), F.lit(True).alias("_in_new"))
    cond: Column = F.lit(True)
    for i in range(len(keys)):
        cond = cond & F.col(f"_l{i}").eqNullSafe(F.col(f"_r{i}"))
    both = left.join(right, cond, "full_outer")
    change = (
        F.when(F.col("_in_old").isNull(), "insert").when(F.col("_in_new").isNull(), "delete")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "same").otherwise("update")
    )
    names = [F.when(F.col("_in_new"), F.col(f"_r{i}")).otherwise(F.col(f"_l{i}")).alias(k) for i, k in enumerate(keys)]
    return both.select(*names, change.alias("_change"), "_old", "_new")


def snapshot_scd1(target: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The target becomes the snapshot; also the number of keys per kind of change."""
    diff = snapshot_diff(target, snapshot, keys)
    now = diff.filter(F.col("_change") != "delete").select(*keys, "_new.*")
    return now, diff.groupBy("_change").agg(F.count(F.lit(1)).alias("n"))


def snapshot_scd2(history: DataFrame, snapshot: DataFrame, keys: Sequence[str], version: Column) -> DataFrame:
    """New keys open, changed ones close and open, missing ones close, equal ones stay."""
    done = history.filter(F.col(END).isNotNull())
    live = history.filter(F.col(END).isNull())
    body = [c for c in history.columns if c not in (*keys, START, END)]
    kind = history.schema[START].dataType
    starts = live.select(*keys, START)
    diff = snapshot_diff(live.select(*keys, *body), snapshot.select(*keys, *body), keys)
    gone = F.col("_change").isin("update", "delete")
    old = join_on(diff.filter(F.col("_change") != "insert"), starts, keys).select(
        *keys, "_old.*", F.col(START), F.when(gone, version.cast(kind)).alias(END)
    )
    new = diff.filter(F.col("_change").isin("insert", "update")).select(
        *keys, "_new.*", version.cast(kind).alias(START), F.lit(None).cast(kind).alias(END)
    )
    return done.unionByName(old.select(*history.columns)).unionByName(new.select(*history.columns))


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], files: int | None = None) -> None:
    """Range-partitioned and sorted files, so statistics on ``cols`` let later reads skip data."""
    spread = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    spread.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def write_blobs(df: DataFrame, root: str, path_col: str, bin_col: str) -> DataFrame:
    """One file per row at ``root/path_col``; ``written_path`` is its full name, with the scheme that ``root`` has.

    Files go through the file system that the scheme of ``root`` names (a plain path: a folder every executor has
    mounted). Where that can rename, a file is written under another name first; a store of objects shows a file only
    when it is whole. So a repeated task leaves the same result. A row without data or name, or whose name leads out of
    ``root``, gets a null path; a write that fails fails its task.
    """
    import pyarrow as pa

    base = root.rstrip("/")
    rest = [c for c in df.columns if c != bin_col]
    schema = df.select(*rest, F.lit(None).cast("string").alias("written_path")).schema

    def write(batches):
        import os
        import uuid

        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", re.sub("^file:/*", "file:///", base)))
        renames, made = store.type_name in ("local", "hdfs"), set()
        for batch in batches:
            paths = []
            for name, data in zip(batch.column(path_col).to_pylist(), batch.column(bin_col)):
                if name is None or not data.is_valid or not name.strip("/") or ".." in name.split("/"):
                    paths.append(None)
                    continue
                full = f"{folder}/{name.lstrip('/')}"
                if renames and (parent := os.path.dirname(full)) not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                place = f"{full}.{uuid.uuid4().hex}.part" if renames else full
                with store.open_output_stream(place) as out:
                    out.write(data.as_buffer())
                if renames:
                    store.move(place, full)
                paths.append(f"{base}/{name.lstrip('/')}")
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(paths, pa.string())], [*rest, "written_path"])

    return df.mapInArrow(write, schema)


class VersionedTable:
    """A Parquet table in buckets of keys: a folder per version and bucket, and a log of finished ones.

    A version writes the buckets it is given, of a table without ``keys`` the only one; the newest version of each
    bucket is what is read, so the files of other buckets stay untouched. A half-written version is never read, and
    applying the same version twice changes nothing. The number of buckets is that of the first version. It bounds what
    the driver holds: one row of the log and one path a bucket.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), buckets: int = 256):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets = buckets if keys else 1

    def _log(self) -> list:
        """Per bucket its newest version, and how many rows and which columns that has."""
        try:
            log = self.spark.read.schema("version bigint, bucket int, n bigint, columns string, buckets int").parquet(f"{self.path}/log")
            return log.groupBy("bucket").agg(F.max_by(F.struct("version", "n", "columns", "buckets"), "version").alias("b")).select("bucket", "b.*").collect()
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def version(self) -> int | None:
        return max((r["version"] for r in self._log()), default=None)

    def read(self, only: Sequence[int] | None = None) -> DataFrame | None:
        """The newest rows of all buckets, or of ``only`` some."""
        log = self._log()
        if not log:
            return None
        schema = T.StructType.fromJson(json.loads(max(log, key=lambda r: r["version"])["columns"]))
        paths = [f"{self.path}/data/v={r['version']}/_bucket={r['bucket']}" for r in log if r["n"] and (only is None or r["bucket"] in only)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _bucket(self, log: list) -> Column:
        of = log[0]["buckets"] if log else self.buckets
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(of)).cast("int") if self.keys else F.lit(0)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of ``rows`` lie in."""
        return sorted(r["b"] for r in rows.select(self._bucket(self._log()).alias("b")).distinct().collect())

    def within(self, rows: DataFrame, only: Sequence[int]) -> DataFrame:
        """The ``rows`` whose keys lie in ``only`` some buckets."""
        return rows.filter(self._bucket(self._log()).isin(list(only)))

    def replace(self, df: DataFrame, version: int, cluster_by: Sequence[str] = (), only: Sequence[int] | None = None) -> bool:
        """Put ``df`` in the place of the whole table, or of ``only`` the buckets that all its rows lie in."""
        log = self._log()
        if log and max(r["version"] for r in log) >= version:
            return False
        of, target = log[0]["buckets"] if log else self.buckets, f"{self.path}/data/v={version}"
        rows = df.withColumn("_bucket", self._bucket(log))
        if self.keys or cluster_by:  # a large bucket is spread over tasks by range
            order = ["_bucket", *(cluster_by or self.keys)]
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        rows.write.mode("overwrite").partitionBy("_bucket").parquet(target)
        kept = T.StructType([*df.schema.fields, T.StructField("_bucket", T.IntegerType())])
        counts = self.spark.read.schema(kept).parquet(target).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
        written = {r["_bucket"]: r["n"] for r in counts.collect()}
        shape = df.schema.json()
        entries = [(version, b, written.get(b, 0), shape, of) for b in (range(of) if only is None else only)]
        self.spark.createDataFrame(entries, "version bigint, bucket int, n bigint, columns string, buckets int").coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return True

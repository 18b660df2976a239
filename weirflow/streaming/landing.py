"""Streams into tables: drains, keyed upserts, deletes, appends, late rows, per-key watermarks.

Every write is keyed by the batch number, so a batch that runs again after a failure leaves the
same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.contracts import SpecError, TableContract, TablePlan, resolve, validate_spec
from weirflow.operators.changes import (
    DELETED, END, START, VersionedTable, one_per_key, scd1, scd2_apply, scd2_state, snapshot_diff, snapshot_scd1, snapshot_scd2, visible,
)
from weirflow.sources.incremental import newest_marks, past_marks


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A folder as a stream; the file list of every batch is logged, so a replay reads the same rows."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def drain(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``step`` on each batch until what was there at the start is used up, then stop."""
    work = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    work.trigger(availableNow=True).start().awaitTermination()


class UpsertTable:
    """Keyed state as a base plus one small frame per batch, merged when read.

    A batch writes only its own rows (one per key), not the whole target; every ``compact_every``
    batches the base is written anew, and the frames it then holds are emptied.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], seq: Sequence[str], compact_every: int = 20):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.seq, self.compact_every = list(keys), list(seq), compact_every
        self.base = VersionedTable(spark, f"{self.path}/base")

    def _deltas(self, after: int | None, before: int | None = None) -> DataFrame | None:
        try:
            df = self.spark.read.option("basePath", f"{self.path}/delta").parquet(f"{self.path}/delta")
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if after is not None:
            df = df.filter(F.col("_batch") > after)
        if before is not None:
            df = df.filter(F.col("_batch") < before)
        return df.drop("_batch")

    def state(self, before: int | None = None) -> DataFrame | None:
        """One row per key, removed keys marked in ``_deleted``; as it was ``before`` a batch that is not compacted yet."""
        base, rest = self.base.read(), self._deltas(self.base.version(), before)
        if base is None and rest is None:
            return None
        return scd1(base, rest, self.keys, self.seq)

    def read(self) -> DataFrame | None:
        now = self.state()
        return None if now is None else visible(now)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        best = scd1(None, batch, self.keys, self.seq)
        best.write.mode("overwrite").parquet(f"{self.path}/delta/_batch={batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            held = self.base.version()
            self.base.replace(self.state(), batch_id)
            for done in range(0 if held is None else held + 1, batch_id + 1):
                best.limit(0).write.mode("overwrite").parquet(f"{self.path}/delta/_batch={done}")


def upsert_stream(stream: DataFrame, target: UpsertTable, checkpoint: str) -> None:
    drain(stream, lambda batch, number: target.apply(batch, number), checkpoint)


def with_deletes(upserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """Upserts and tombstones as one tagged stream, so one query writes the target."""
    return upserts.withColumn(DELETED, F.lit(False)).unionByName(
        deletes.withColumn(DELETED, F.lit(True)), allowMissingColumns=True
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Rows appended exactly once: the file sink's own log drops repeated batches."""
    sink = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    sink.trigger(availableNow=True).start().awaitTermination()


def drop_late_duplicates(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """For append targets read with a lookback: a key seen within ``delay`` is dropped when it comes again."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def watermark_stream(
    stream: DataFrame, keys: Sequence[str], cursor: str, marks: UpsertTable,
    land: Callable[[DataFrame, int], None], checkpoint: str, token: str | None = None,
) -> None:
    """Per batch only rows past the key's own watermark land, then the watermarks of their keys move on.

    ``marks`` keeps per key ``watermark`` and, where a ``token`` column orders rows of equal cursor, the ``token`` of its
    newest row, from which a source can be resumed; rows are then compared by both. A batch writes the marks of its own
    keys only. They are joined to the batch, so a key with very many rows is spread over tasks like any other. A batch
    that runs again reads the marks as they were before it and lands the same rows.
    """

    def step(batch: DataFrame, number: int) -> None:
        held = marks.base.version()
        if held is not None and held >= number:
            return
        before = marks.state(before=number)
        fresh = batch if before is None else past_marks(batch, keys, cursor, visible(before), token)
        land(fresh, number)
        marks.apply(newest_marks(fresh, keys, cursor, token), number)

    drain(stream, step, checkpoint)


def round_trip(batch: DataFrame, streamed: DataFrame) -> DataFrame:
    """One row: how many rows only one side holds; both are 0 when the stream equals the batch read."""
    cols = batch.columns
    lost = batch.select(*cols).exceptAll(streamed.select(*cols)).select(F.lit(True).alias("lost"))
    extra = streamed.select(*cols).exceptAll(batch.select(*cols)).select(F.lit(False).alias("lost"))
    return lost.unionByName(extra).agg(F.count_if("lost").alias("only_batch"), F.count_if(~F.col("lost")).alias("only_stream"))


Reader = Callable[[], "tuple[DataFrame, DataFrame | None]"]


def land_table(spark: SparkSession, plan: TablePlan, read: Reader, root: str, version: int) -> DataFrame:
    """One table of a run: pick the way to land it by its ingestion and history type, and write it.

    An append adds a folder of new files, a keyed table one frame of its changes; neither rewrites what earlier
    runs wrote, and a run that is repeated writes its own folder again. Snapshots and histories lie in buckets of keys, and
    a run writes only those buckets anew that hold a key it changes.
    """
    path = f"{root}/{plan.destination}"
    rows, deletes = read()
    keys, seq, kind = list(plan.primary_keys), plan.sequence_by, plan.ingestion_type
    history = plan.scd_type == "SCD_TYPE_2"
    if kind == "append":
        rows.write.mode("overwrite").parquet(f"{path}/rows/_run={version}")
        return spark.read.option("mergeSchema", "true").option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("_run")
    if kind != "snapshot" and not history:
        target = UpsertTable(spark, path, keys, [seq])
        target.apply(rows.withColumn(DELETED, F.lit(False)) if deletes is None else with_deletes(rows, deletes), version)
        return target.read()
    store = VersionedTable(spark, path, keys)
    first, touched = store.version() is None, None
    if kind == "snapshot":
        if first:
            out = one_per_key(rows, keys)
            if history:
                out = out.select("*", F.lit(version).cast("bigint").alias(START), F.lit(None).cast("bigint").alias(END))
        else:
            now = store.read()
            live = now.filter(F.col(END).isNull()).drop(START, END) if history else now
            touched = store.touched(snapshot_diff(live, rows.select(*live.columns), keys).filter("_change <> 'same'"))
            now, part = store.read(touched), store.within(rows, touched)
            out = snapshot_scd2(now, part, keys, F.lit(version)) if history else snapshot_scd1(now, part, keys)[0]
    elif first:
        out = scd2_state(rows, keys, seq, deletes)
    else:
        changed = rows.select(*keys) if deletes is None else rows.select(*keys).unionByName(deletes.select(*keys))
        touched = store.touched(changed)
        out = scd2_apply(store.read(touched), rows, keys, seq, deletes)
    if touched is None or touched:
        store.replace(out, version, plan.cluster_by, touched)
    landed = store.read()
    return visible(landed) if DELETED in landed.columns else landed


def run_spec(
    spark: SparkSession, spec: dict, registry: dict[str, tuple[TableContract | None, Reader]], root: str, version: int = 0
) -> dict[str, DataFrame]:
    """Land every table of a specification; gives the landed tables by destination."""
    _, plans = validate_spec(spec)
    out = {}
    for plan in plans:
        if plan.source_table not in registry:
            raise SpecError(f"unknown table {plan.source_table}")
        contract, read = registry[plan.source_table]
        full = resolve(plan, contract)
        out[full.destination] = land_table(spark, full, read, root, version)
    return out

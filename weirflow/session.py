"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the local benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weirflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session on this machine alone (tests, local runs) that names none gets a temporary folder; on a cluster
    executors would each write to their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weirflow-"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, stem: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, stem: str = "cut", compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a plan cut that outlives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, stem)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df`` dealt evenly over tasks of at most about ``rows`` rows, for work that costs much more than reading.

    Files are split by bytes and row groups, so a narrow table with millions of rows would be one task. Small tables get
    a task for every 500 rows, up to the cores there are.
    """
    found = df.count()
    tasks = max(math.ceil(found / rows), min(math.ceil(found / 500), df.sparkSession.sparkContext.defaultParallelism), 1)
    return df.repartition(tasks)

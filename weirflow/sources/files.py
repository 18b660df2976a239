"""File reads: modification-time scans, listings, sheets with a header row, reports, JSON lines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.functions.scalars import report_header_name, safe_column_name_text


def _stamp(moment: Any) -> str:
    value = moment if isinstance(moment, datetime) else datetime.fromisoformat(str(moment))
    return value.strftime("%Y-%m-%dT%H:%M:%S")


def file_scan(
    spark: SparkSession, path: str, glob: str = "*", recursive: bool = True, since: Any = None, until: Any = None
) -> DataFrame:
    """Text of whole files changed in ``(since, until]``: path, modified, content. Empty files are left out."""
    reader = spark.read.option("pathGlobFilter", glob)
    reader = reader.option("recursiveFileLookup", str(recursive).lower()).option("ignoreCorruptFiles", "true")
    if since is not None:
        # The listing filter works on whole seconds; the exact rule is applied to the rows below.
        reader = reader.option("modifiedAfter", _stamp(datetime.fromisoformat(_stamp(since)) - timedelta(seconds=1)))
    modified = F.col("_metadata.file_modification_time")
    df = reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), modified.alias("modified"), F.col("value").alias("content")
    )
    if since is not None:
        df = df.filter(F.col("modified") > F.lit(_stamp(since)).cast("timestamp"))
    if until is not None:
        df = df.filter(F.col("modified") <= F.lit(_stamp(until)).cast("timestamp"))
    return df.filter(F.length("content") > 0)


def first_cursor(files: DataFrame) -> DataFrame:
    """One row: the oldest modification time less one second, so a strict ``>`` reads that file too."""
    return files.agg((F.min("modified") - F.expr("interval 1 second")).alias("cursor"))


def list_files(spark: SparkSession, path: str, glob: str = "*", with_content: bool = False) -> DataFrame:
    """Files with name, length and modification time, newest first; bytes are read only when asked for."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    cols = [F.col("path").alias("id"), name.alias("name"), F.regexp_extract(name, r"\.([^.]+)$", 1).alias("type"),
            F.col("modificationTime").alias("modified"), F.col("length")]
    if with_content:
        cols.append(F.col("content"))
    return df.select(*cols).orderBy(F.desc("modified"), "id")


def header_row_table(rows: DataFrame, use_header: bool = True, index: str = "row_index", values: str = "values") -> DataFrame:
    """A sheet given as ``(row_index, values[])``: row 1 names the columns and every other row fills them.

    Short rows and null cells become empty strings, cells beyond the header are dropped. Without a
    header the rows come back as they are.
    """
    if not use_header:
        return rows.select(index, values)
    first = rows.filter(F.col(index) == 1).select(values).head()
    if first is None:
        return rows.select(index).limit(0)
    names = [safe_column_name_text(cell, i) for i, cell in enumerate(first[0])]
    cells = [F.coalesce(F.try_element_at(values, F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)]
    return rows.filter(F.col(index) > 1).select(F.col(index).alias("row_index"), *cells)


def csv_report(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """A report with a header line: names in lower case with underscores, empty text as null."""
    df = spark.read.option("header", "true").option("encoding", encoding).option("multiLine", "false").csv(path)
    # A byte order mark stays on the first name.
    names = [report_header_name(c.replace("﻿", "")) for c in df.columns]
    df = df.toDF(*names)
    return df.select(*[F.nullif(F.col(n), F.lit("")).alias(n) for n in names])


def ndjson_scan(spark: SparkSession, path: str, schema: Any) -> tuple[DataFrame, DataFrame]:
    """JSON lines as typed rows, and the lines that are not JSON; blank lines are skipped."""
    shape = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return parse_lines(lines, "value", shape)


def parse_lines(lines: DataFrame, col: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = lines.select(
        F.col(col), F.from_json(col, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r")
    )
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return parsed.filter(~bad).select(*[F.col(f"r.`{f.name}`") for f in schema.fields]), parsed.filter(bad).select(col)


def unwrap_records(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """One row ``record`` (variant) per element of a body that is ``[...]`` or ``{key: [...]}``.

    Hint keys are tried in order; without a hit the field with the longest list of objects is taken.
    """
    rest = [c for c in df.columns if c != col]
    rows = df.select(*rest, F.try_parse_json(F.col(col)).alias("_b"))
    listed = [F.try_variant_get("_b", "$", "array<variant>")]
    listed += [F.try_variant_get("_b", f"$['{k}']", "array<variant>") for k in keys]
    rows = rows.select(*rest, "_b", F.coalesce(*listed).alias("_list"))
    fields = F.map_values(F.try_variant_get("_b", "$", "map<string,variant>"))
    lists = F.transform(fields, lambda v: F.try_variant_get(v, "$", "array<variant>"))
    objects = F.filter(lists, lambda a: a.isNotNull() & (F.size(a) > 0) & F.schema_of_variant(a[0]).startswith("OBJECT"))
    longest = F.reduce(objects, F.lit(None).cast("array<variant>"),
                       lambda best, a: F.when(best.isNull() | (F.size(a) > F.size(best)), a).otherwise(best))
    return rows.select(*rest, F.explode(F.when(F.col("_list").isNotNull(), F.col("_list")).otherwise(longest)).alias("record"))

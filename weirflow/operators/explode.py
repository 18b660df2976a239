"""One row into many: nested lists, series, maps, trees, repeated parts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.operators.ordered import with_position
from weirflow.session import cut_lineage


def child_events(df: DataFrame, col: str = "child_events", kind: str = "Comment", kind_field: str = "event_type") -> DataFrame:
    """Parent rows with each child of a kind: parent columns first, a child's value wins over the parent's."""
    child = F.col("_c")
    names = [f.name for f in df.schema[col].dataType.elementType.fields]
    rows = df.withColumn("_c", F.explode(col)).filter(child[kind_field] == kind)
    outer = [c for c in df.columns if c != col]
    cols = [F.coalesce(child[c], F.col(c)).alias(c) if c in names else F.col(c) for c in outer]
    return rows.select(*cols, *[child[n].alias(n) for n in names if n not in outer])


def record_rows(df: DataFrame, col: str) -> DataFrame:
    """The structs of an array as rows under the envelope's columns."""
    outer = [c for c in df.columns if c != col]
    return df.select(*outer, F.inline(col))


def pages_questions(df: DataFrame, survey: str = "id", pages: str = "pages") -> DataFrame:
    """Survey, page and question, each question with both parent ids."""
    page = df.select(F.col(survey).alias("survey_id"), F.explode(pages).alias("p"))
    one = page.select("survey_id", F.col("p.id").alias("page_id"), F.explode("p.questions").alias("q"))
    fields = [f.name for f in one.schema["q"].dataType.fields if f.name != "id"]
    return one.select("survey_id", "page_id", F.col("q.id").alias("question_id"), *[F.col(f"q.{f}").alias(f) for f in fields])


def series_rows(df: DataFrame, col: str) -> DataFrame:
    """``{series: [[n..]..], xValues: [..], seriesMeta: [..]}`` JSON as rows ``(date, count, segment)``.

    A series is cut at the shorter of itself and the x values; a label that is no text is ``Totals``.
    """
    rest = [c for c in df.columns if c != col]
    rows = df.select(*rest, F.try_parse_json(F.col(col)).alias("_v")).select(
        *rest, F.try_variant_get("_v", "$.series", "array<array<variant>>").alias("_series"),
        F.try_variant_get("_v", "$.xValues", "array<string>").alias("_xs"),
        F.try_variant_get("_v", "$.seriesMeta", "array<variant>").alias("_meta"),
    )
    rows = rows.select(*rest, "_xs", "_meta", F.posexplode("_series").alias("_i", "_ys"))
    rows = rows.withColumn("_label", F.try_element_at("_meta", F.col("_i") + 1))
    text = F.when(F.schema_of_variant("_label") == "STRING", F.try_variant_get("_label", "$", "string"))
    rows = rows.withColumn("segment", F.coalesce(text, F.lit("Totals")))
    rows = rows.select(*rest, "_xs", "segment", F.posexplode("_ys").alias("_j", "_y")).filter(F.col("_j") < F.size("_xs"))
    return rows.select(*rest, F.element_at("_xs", F.col("_j") + 1).alias("date"), F.try_variant_get("_y", "$", "bigint").alias("count"), "segment")


def map_rows(df: DataFrame, col: str, key: str = "name", value: str = "value", skip_null: bool = True) -> DataFrame:
    """Map entries as rows; a null value is left out, or becomes the empty text."""
    outer = [c for c in df.columns if c != col]
    rows = df.select(*outer, F.explode(col).alias(key, value))
    return rows.filter(F.col(value).isNotNull()) if skip_null else rows.withColumn(value, F.coalesce(value, F.lit("")))


def tree_walk(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Rows of a parent-pointer tree with ``depth`` and ``path`` from the root (no parent) down.

    Pointer doubling: every row knows an ancestor and the path below it, and takes over its ancestor's own
    ancestor and path, so a round reaches twice as far and a chain of n rows takes log2(n) rounds. Each
    round is written to the shared folder. A row without key is skipped and its subtree with it, and so are
    rows that lead to no root: below a missing parent, or in or below a cycle.
    """
    rows = df.filter(F.col(key).isNotNull())
    root = F.coalesce(F.col(parent).cast("string"), F.lit("")) == ""
    start = rows.withColumns({"depth": F.when(root, 0).otherwise(1), "path": F.col(key).cast("string"), "_far": F.when(~root, F.col(parent))})
    open_ = start.filter(F.col("_far").isNotNull())
    done = [start.filter(F.col("_far").isNull())]
    while True:
        reached = done[0]
        for part in done[1:]:
            reached = reached.unionByName(part)
        up = reached.unionByName(open_).select(F.col(key).alias("_key"), F.col("depth").alias("_depth"), F.col("path").alias("_path"), F.col("_far").alias("_next"))
        moved = open_.join(up, F.col("_far") == F.col("_key")).withColumns({
            "depth": F.col("depth") + F.col("_depth"), "path": F.concat_ws("/", "_path", "path"), "_far": F.col("_next"),
        })
        state = cut_lineage(moved.drop("_key", "_depth", "_path", "_next"), "walk")
        done.append(state.filter(F.col("_far").isNull()))
        # Depths have no gaps: a round that brings no row to its root leaves none that could get there.
        if done[-1].isEmpty():
            return reached.drop("_far")
        open_ = state.filter(F.col("_far").isNotNull())


def nested_tree(spark, df: DataFrame, col: str, key: str = "id", children: str = "children") -> DataFrame:
    """A nested JSON element (variant) as rows ``(element, parent, depth)``; elements without key and their
    subtree are skipped."""
    outer = [c for c in df.columns if c != col]
    level = df.select(*outer, F.col(col).alias("_n"), F.lit("").alias("parent"))
    out = None
    for depth in count():
        named = level.withColumn("element", F.try_variant_get("_n", f"$['{key}']", "string")).filter(F.col("element").isNotNull())
        part = named.select(*outer, "element", "parent", F.lit(depth).alias("depth"))
        out = part if out is None else out.unionByName(part)
        level = cut_lineage(named.select(
            *outer, F.explode(F.try_variant_get("_n", f"$['{children}']", "array<variant>")).alias("_n"),
            F.col("element").alias("parent"),
        ), "nodes")
        if level.limit(1).count() == 0:
            return out


def id_chunks(df: DataFrame, key: str, n: int) -> DataFrame:
    """Add ``chunk`` 0.. of ``n`` ids each in key order; ``n`` below 1 means a single chunk."""
    if n <= 0:
        return df.withColumn("chunk", F.lit(0).cast("bigint"))
    placed = with_position(df, [], [key], "_place")
    return placed.withColumn("chunk", F.floor((F.col("_place") - 1) / n)).drop("_place")


def repetitions(field: Column, part, sep: str = "~") -> Column:
    """The parts of a repeated field, empty ones skipped; null when none is left."""
    kept = F.filter(F.split(field, F.lit("\\Q" + sep + "\\E")), lambda x: x != "")
    return F.when(F.size(kept) > 0, F.transform(kept, part))


def is_struct_array(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)

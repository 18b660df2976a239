"""Change feeds: logs, delta rows and archive flags turned into upserts and tombstones."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.sources.incremental import bound


def history_added(log: DataFrame, added: str = "messagesAdded", log_id: str = "id") -> DataFrame:
    """Distinct message ids a change log added, each with the first log entry that names it."""
    seen = log.select(F.col(log_id).alias("log_id"), F.explode(added).alias("e"))
    return seen.groupBy(F.col("e.message.id").alias("message_id")).agg(F.min("log_id").alias("log_id"))


def history_deleted(log: DataFrame, entity: str, deleted: str = "messagesDeleted", log_id: str = "id") -> DataFrame:
    """Distinct tombstones of an entity (``message`` or its ``thread``); the first log entry wins."""
    if entity not in ("message", "thread"):
        raise ValueError("entity must be message or thread")
    part = "e.message.id" if entity == "message" else "e.message.threadId"
    seen = log.select(F.col(log_id).alias("log_id"), F.explode(deleted).alias("e"))
    seen = seen.select(F.col(part).alias("id"), "log_id").filter(F.col("id").isNotNull())
    return seen.groupBy("id").agg(F.min("log_id").alias("log_id"))


def delta_feed(
    df: DataFrame, keys: Sequence[str], removed: Column, at: str, payload: Sequence[str]
) -> DataFrame:
    """Delta rows with ``_deleted``; a removed row keeps only its keys and its time."""
    gone = F.coalesce(removed, F.lit(False))
    body = [F.when(~gone, F.col(c)).alias(c) for c in payload if c not in keys and c != at]
    return df.select(*keys, *body, at, gone.alias("_deleted"))


def archived_as_deletes(df: DataFrame, flag: Column, at: str, cursor: str, since: Any = None) -> DataFrame:
    """Archived rows as tombstones: the archive time becomes the cursor and must lie above ``since``."""
    rows = df.filter(flag)
    if since is not None:
        rows = rows.filter(F.col(at) > bound(df, at, since))
    return rows.withColumn(cursor, F.col(at))

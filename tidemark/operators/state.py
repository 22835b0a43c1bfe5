"""Sync state and log, as a merge by key and an append-only log (#56-#59)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import local_frame

STATE = "entity_name string, state string, last_sync_time string, last_timestamp string, records_count long"
LOG = "id string, entity_name string, start_time string, end_time string, records_added long, records_updated long, status string, error_message string"
IN_PROGRESS, COMPLETED, FAILED = "in_progress", "completed", "failed"


def empty_state(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [], STATE)


def empty_log(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [], LOG)


def set_state(state: DataFrame, changes: DataFrame) -> DataFrame:
    """state after changes(entity_name, state, last_sync_time, last_timestamp, records_count); null last_timestamp and records_count keep what was there."""
    new = changes.select(*[F.col(c).alias(f"_{c}") if c != "entity_name" else F.col(c) for c in state.columns])
    j = state.join(new, "entity_name", "full_outer")
    return j.select("entity_name", *[F.coalesce(f"_{c}", c).alias(c) for c in state.columns if c != "entity_name"])


def get_state(state: DataFrame, entity: str) -> DataFrame:
    return state.where(F.col("entity_name") == entity)


def latest_log(events: DataFrame) -> DataFrame:
    """The log as appended events (several a run id) -> one row a run, by its last event."""
    rank = F.when(F.col("status") == IN_PROGRESS, 0).otherwise(1)
    last = events.groupBy("id").agg(F.max_by(F.struct(*[c for c in events.columns if c not in ("id", "start_time")]), F.struct(rank, "end_time")).alias("_x"), F.min("start_time").alias("start_time"))
    return last.select(*[F.col("id") if c == "id" else F.col("start_time") if c == "start_time" else F.col(f"_x.{c}").alias(c) for c in events.columns])

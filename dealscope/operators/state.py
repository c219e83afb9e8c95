"""Sync state: one row per object type, with the marks of its last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.schemas import LANDING_STATE, SYNC_STATE
from dealscope.sources.curated import overwrite_partitions, read_curated


def read_sync_state(spark: SparkSession, path: str) -> DataFrame | None:
    """Whole state table, or None before the first run."""
    return read_curated(spark, path, SYNC_STATE)


def get_sync_state(spark: SparkSession, path: str, object_type: str) -> dict | None:
    """State of one object type; the table has one row for it."""
    table = read_sync_state(spark, path)
    if table is None:
        return None
    row = table.filter(F.col("object_type") == object_type).first()
    return None if row is None else row.asDict()


def put_sync_state(
    spark: SparkSession,
    path: str,
    object_type: str,
    synced_at: str,
    last_created_at: str | None = None,
    last_modified_at: str | None = None,
    records_processed: int = 0,
) -> None:
    """Record a run. Marks it does not give, as after an empty run, stay as they were."""
    before = get_sync_state(spark, path, object_type) or {}
    row = (
        synced_at,
        last_created_at or before.get("last_created_at"),
        last_modified_at or before.get("last_modified_at"),
        records_processed,
        object_type,
    )
    update = spark.createDataFrame([row], SYNC_STATE)
    overwrite_partitions(update, path, ["object_type"])


def _landing_path(path: str) -> str:
    return f"{path}_landed"


def get_landing_mark(spark: SparkSession, path: str, object_type: str) -> str | None:
    """Latest landing date that a run of this object type has read; None before the first."""
    table = read_curated(spark, _landing_path(path), LANDING_STATE)
    if table is None:
        return None
    row = table.filter(F.col("object_type") == object_type).first()
    return None if row is None else row["last_landed"]


def put_landing_mark(
    spark: SparkSession, path: str, object_type: str, last_landed: str | None
) -> None:
    """Record the date up to which the landing folders are read; it never falls."""
    before = get_landing_mark(spark, path, object_type)
    if last_landed is None or (before is not None and before >= last_landed):
        return
    update = spark.createDataFrame([(last_landed, object_type)], LANDING_STATE)
    overwrite_partitions(update, _landing_path(path), ["object_type"])

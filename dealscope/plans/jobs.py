"""Sync jobs: raw table to curated table, full or incremental, one per object type."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dealscope import vocabulary as V
from dealscope.functions.parsing import parse_mixed_timestamp
from dealscope.operators import normalize as N
from dealscope.operators.changes import (
    due_changes,
    later_mark,
    mark_columns,
    not_due,
    sync_window,
)
from dealscope.operators.dedupe import any_order, latest_per_key
from dealscope.operators.merge import full_load, merge_upsert, stage
from dealscope.operators.state import (
    get_landing_mark,
    get_sync_state,
    put_landing_mark,
    put_sync_state,
)
from dealscope.plans import upkeep
from dealscope.schemas import CURATED_SCHEMAS
from dealscope.sources.curated import read_curated, remove, replace_snapshot
from dealscope.sources.raw import read_raw_objects


@dataclass(frozen=True)
class SyncJob:
    """What tells the incremental object types apart."""

    object_type: str
    # Columns of the curated table that tell its rows apart.
    primary_key: tuple[str, ...]
    properties: dict[str, str]
    normalize: Callable[[DataFrame], DataFrame]
    # Applied to the latest versions.
    clean: Callable[[DataFrame], DataFrame]
    # Versions without a creation time do not count.
    dated: bool = False
    # Rows that can move to another partition are looked for in all partitions.
    global_key: bool = False


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


def _typed_activities(rows: DataFrame) -> DataFrame:
    """Activities of two object types may share an id, so the type stays in the table."""
    return N.normalize_activities(rows, keep=["object_type"])


JOBS = {
    job.object_type: job
    for job in [
        SyncJob(
            "deals",
            ("deal_id",),
            V.DEAL_PROPERTIES,
            N.normalize_deals,
            DataFrame.dropDuplicates,
        ),
        SyncJob(
            "activities",
            ("object_type", "activity_id"),
            V.ACTIVITY_PROPERTIES,
            _typed_activities,
            N.keep_dated_distinct,
            dated=True,
        ),
        SyncJob(
            "contacts",
            ("contact_id",),
            V.CONTACT_PROPERTIES,
            N.normalize_contacts,
            _as_is,
        ),
        SyncJob(
            "companies",
            ("company_id",),
            V.COMPANY_PROPERTIES,
            N.normalize_companies,
            _as_is,
            global_key=True,
        ),
    ]
}


def sync_table(
    object_type: str,
    raw: DataFrame,
    path: str,
    state_path: str,
    now: datetime,
    incremental: bool = True,
    monthly_path: str | None = None,
) -> int:
    """Bring a curated table up to the raw one and record the run; rows written.

    Both modes have one row per raw key, its latest version; rows without an id drop out. An
    incremental run takes what was created or modified since the stored marks less two
    hours, and merges it; of stored and incoming versions the latest stays, so it ends with
    the rows that a full run would give. A first or full run replaces the table. Versions
    whose times all lie beyond ``now`` wait until they are due. The rows are computed once
    and written beside the table; count and marks come from that write. A mark is never
    later than ``now`` and never earlier than the stored one. A run without rows only
    records that it ran. With ``monthly_path`` a run over deals keeps the parts of their
    monthly KPIs up to date there (``plans.upkeep``).
    """
    job = JOBS[object_type]
    spark = raw.sparkSession
    state = get_sync_state(spark, state_path, object_type)
    window = sync_window(state, incremental)

    source = due_changes(raw, *_times(job), window, now)
    normal = job.normalize(source)
    counted = F.col(job.primary_key[-1]) != ""
    if job.dated:
        counted = counted & F.col("created_at").isNotNull()
    # Equal rows have one key, so cleaning the latest versions gives what taking the latest of
    # clean ones gives, and needs no shuffle of its own.
    rows = job.clean(
        latest_per_key(
            normal.filter(counted),
            job.primary_key,
            [*_latest_first(), any_order(normal.columns)],
        )
    )

    seen = Observation()
    copy = f"{path}_incoming"
    staged = stage(rows.observe(seen, *mark_columns(rows, now)), copy)
    marks = seen.get
    synced_at = now.isoformat()
    if not marks["rows"]:
        put_sync_state(spark, state_path, object_type, synced_at)
    else:
        if window.incremental:
            _merge(job, staged, path, monthly_path)
        else:
            if monthly_path is not None:
                upkeep.build_monthly(staged, monthly_path)
            full_load(staged, path, staged=True)
        before = state or {}
        put_sync_state(
            spark,
            state_path,
            object_type,
            synced_at,
            later_mark(before.get("last_created_at"), marks["max_created_at"]),
            later_mark(before.get("last_modified_at"), marks["max_modified_at"]),
            marks["rows"],
        )
    remove(spark, copy)
    return marks["rows"]


def _latest_first() -> list[Column]:
    return [F.desc_nulls_last(F.col(c)) for c in ("last_modified_at", "created_at")]


def _times(job: SyncJob) -> tuple[Column, Column]:
    created, modified = (
        parse_mixed_timestamp(N.prop(job.properties[c])) for c in ("created_at", "last_modified_at")
    )
    return created, modified


def _merge(job: SyncJob, staged: DataFrame, path: str, monthly_path: str | None) -> None:
    spark = staged.sparkSession
    kept = monthly_path is not None and upkeep.has_monthly(spark, monthly_path)

    def on_change(old: DataFrame | None, new: DataFrame, affected: DataFrame) -> None:
        upkeep.refresh_monthly(new, affected, monthly_path)

    merge_upsert(
        staged,
        path,
        job.primary_key,
        latest_first=_latest_first(),
        global_key=job.global_key,
        staged=True,
        incoming_first=False,
        on_change=on_change if kept else None,
    )
    if monthly_path is not None and not kept:
        upkeep.build_monthly(read_curated(spark, path, CURATED_SCHEMAS["deals"]), monthly_path)


def sync_landed(
    object_type: str,
    spark: SparkSession,
    landing: str,
    path: str,
    state_path: str,
    now: datetime,
    incremental: bool = True,
    overlap_days: int = 1,
    monthly_path: str | None = None,
) -> int:
    """``sync_table`` over objects in ``landed=<date>/`` folders below ``landing``.

    An incremental run lists and scans the folders from the last landing date that a run has
    read, less ``overlap_days`` for files that came late. What was landed earlier has been
    merged then, except for versions that were not due yet: those wait in a table beside the
    curated one, so that no later run has to look for them. The landing date is recorded
    after everything else, so a run that fails is repeated in full.
    """
    mark = get_landing_mark(spark, state_path, object_type)
    resumed = incremental and mark is not None
    since = (date.fromisoformat(mark) - timedelta(days=overlap_days)).isoformat() if resumed else ""
    seen = Observation()
    waiting = not_due(*_times(JOBS[object_type]), now)
    scanned = read_raw_objects(spark, landing, object_type, since, keep_landed=True)
    raw = scanned.observe(
        seen, F.max("landed").alias("landed"), F.count_if(waiting).alias("waiting")
    ).drop("landed")
    before = read_curated(spark, f"{path}_waiting", raw.schema) if resumed else None
    if before is not None:
        raw = raw.unionByName(before)
    count = sync_table(object_type, raw, path, state_path, now, incremental, monthly_path)
    if before is not None or seen.get["waiting"]:
        still = scanned.drop("landed")
        still = still if before is None else still.unionByName(before)
        # Maps cannot be compared, so versions that wait twice are merged when they are due.
        next_ones = stage(still.filter(waiting), f"{path}_waiting_next")
        stage(next_ones, f"{path}_waiting")
        remove(spark, f"{path}_waiting_next")
    elif not resumed:
        remove(spark, f"{path}_waiting")
    put_landing_mark(spark, state_path, object_type, seen.get["landed"])
    return count


def latest_version(
    raw: DataFrame, keys: Sequence[str], times: Sequence[Column]
) -> DataFrame:
    """One row per key, that with the latest times; rows without an id drop out."""
    order = [F.desc_nulls_last(time) for time in times]
    with_id = raw.filter(F.col(keys[-1]) != "")
    return latest_per_key(with_id, keys, [*order, any_order(raw.columns)])


def sync_owners(raw: DataFrame, path: str) -> None:
    """Replace the owners dimension; an owner's latest version counts."""
    latest = latest_version(raw, ["id"], [F.col("updatedAt"), F.col("createdAt")])
    _replace_dimension(N.normalize_owners(latest), path)


def sync_stages(raw: DataFrame, path: str) -> None:
    """Replace the pipeline stage dimension, one row per pipeline and stage."""
    rows = N.flatten_pipelines(raw)
    order = [any_order(rows.columns)]
    _replace_dimension(latest_per_key(rows, ["pipeline_id", "stage_id"], order), path)


def _replace_dimension(rows: DataFrame, path: str) -> None:
    """Stage the rows and replace the table, unless there are none."""
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    staged = stage(counted, f"{path}_incoming")
    if seen.get["rows"]:
        replace_snapshot(staged, path)
    remove(rows.sparkSession, f"{path}_incoming")

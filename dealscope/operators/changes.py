"""Incremental change selection on landed raw tables, and high-water marks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.functions.parsing import iso_text, iso_to_utc
from dealscope.operators.dedupe import latest_per_key

BUFFER_HOURS = 2


@dataclass(frozen=True)
class SyncWindow:
    """Lower bounds of an incremental run; a full run has none."""

    incremental: bool
    created_since: datetime | None = None
    modified_since: datetime | None = None


def _within(ts: Column, since: datetime | None, until: datetime) -> Column:
    return F.lit(False) if since is None else ts.between(F.lit(since), F.lit(until))


def select_changes(
    rows: DataFrame,
    created: Column,
    modified: Column,
    window: SyncWindow,
    until: datetime,
) -> DataFrame:
    """Rows created in the window as change set 0 and rows modified in it as set 1.

    Bounds are inclusive. A row that is both occurs twice, yet the table is read once.
    """
    in_created = _within(created, window.created_since, until)
    in_modified = _within(modified, window.modified_since, until)
    sets = F.array_compact(F.array(F.when(in_created, F.lit(0)), F.when(in_modified, F.lit(1))))
    return rows.filter(in_created | in_modified).withColumn("change_set", F.explode(sets))


def changed_by(
    rows: DataFrame, created: Column, modified: Column, window: SyncWindow, until: datetime
) -> DataFrame:
    """Rows created or modified within the window, each once."""
    return rows.filter(
        _within(created, window.created_since, until)
        | _within(modified, window.modified_since, until)
    )


def not_due(created: Column, modified: Column, now: datetime) -> Column:
    """Whether all times that a row has lie beyond ``now``."""
    return F.coalesce(F.least(created, modified) > F.lit(now), F.lit(False))


def due_changes(
    rows: DataFrame, created: Column, modified: Column, window: SyncWindow, now: datetime
) -> DataFrame:
    """Rows that count in a run at ``now``: all that are due, or those changed in the window.

    Both ways see the same versions of a row. One that was created by now but says that it
    was modified later is no older than the window, so it counts as changed.
    """
    if not window.incremental:
        return rows.filter(~not_due(created, modified, now))
    changed = _within(created, window.created_since, now) | _within(
        modified, window.modified_since, now
    )
    ahead = (modified > F.lit(now)) & (created <= F.lit(now))
    return rows.filter(changed | ahead)


def latest_changes(
    changes: DataFrame, keys: Sequence[str], within_set: Sequence[Column]
) -> DataFrame:
    """One row per key, the modified set before the created one.

    Rows whose (last) key column is null or empty drop out.
    """
    keyed = changes.filter(F.col(keys[-1]) != "")
    order = [F.col("change_set").desc(), *within_set]
    return latest_per_key(keyed, keys, order).drop("change_set")


def mark_columns(rows: DataFrame, now: datetime | None = None) -> list[Column]:
    """Aggregates: greatest ``created_at`` and ``last_modified_at`` as ISO text, row count.

    Text columns are parsed, unparsable values ignored; a missing column or no value at all
    gives null. With ``now`` a later time counts as now, so that a row dated in the future
    cannot move a mark beyond what later runs read.
    """

    def mark(name: str) -> Column:
        if name not in rows.columns:
            return F.lit(None).cast("string")
        column = F.col(name)
        if rows.schema[name].dataType.typeName() == "string":
            column = iso_to_utc(column)
        if now is not None:
            column = F.when(column > F.lit(now), F.lit(now)).otherwise(column)
        return iso_text(F.max(column))

    return [
        mark("created_at").alias("max_created_at"),
        mark("last_modified_at").alias("max_modified_at"),
        F.count(F.lit(1)).alias("rows"),
    ]


def high_water_marks(rows: DataFrame, now: datetime | None = None) -> DataFrame:
    """The marks of a frame, as one row."""
    return rows.agg(*mark_columns(rows, now))


def later_mark(old: str | None, new: str | None) -> str | None:
    """The later of two marks: a stored mark never falls."""
    if not old or not new:
        return old or new
    return max(old, new, key=datetime.fromisoformat)


def sync_window(
    state: dict | None, incremental: bool, buffer_hours: int = BUFFER_HOURS
) -> SyncWindow:
    """Window of the next run from the stored marks, moved back by the buffer.

    A disabled incremental load, and a first run without state, read everything.
    """
    marks = state or {}
    created, modified = marks.get("last_created_at"), marks.get("last_modified_at")
    if not incremental or not (created or modified):
        return SyncWindow(incremental=False)

    def lowered(mark: str | None) -> datetime | None:
        if not mark:
            return None
        return datetime.fromisoformat(mark) - timedelta(hours=buffer_hours)

    return SyncWindow(True, lowered(created), lowered(modified))


def changed_since(
    rows: DataFrame, created: Column, modified: Column, window: SyncWindow
) -> DataFrame:
    """Rows created or modified since the window's bounds; all rows for a full run."""
    if not window.incremental:
        return rows
    conditions = [
        ts >= F.lit(since)
        for ts, since in ((created, window.created_since), (modified, window.modified_since))
        if since is not None
    ]
    keep = conditions[0]
    for condition in conditions[1:]:
        keep = keep | condition
    return rows.filter(keep)

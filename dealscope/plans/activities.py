"""Activity volume per owner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope import vocabulary as V
from dealscope.config import SalesConfig
from dealscope.functions.calendar import (
    in_weeks,
    local_week,
    long_week_label,
    near_weeks,
    near_weeks_dt,
    recent_weeks,
    week_end,
)
from dealscope.functions.categories import activity_category
from dealscope.operators.lookup import with_owner_name


def with_activity_category(activities: DataFrame) -> DataFrame:
    """Activities with their dashboard category."""
    return activities.withColumn(
        "activity_category",
        activity_category(
            F.col("activity_type"),
            F.col("email_direction"),
            F.col("note_body"),
            F.col("communication_body"),
            F.col("communication_source"),
        ),
    )


def activity_volume_by_owner_type_weekly(activities: DataFrame, owners: DataFrame) -> DataFrame:
    """Activities by owner, UTC week and raw type."""
    happened = F.col("created_at")
    if "occurred_at" in activities.columns:
        happened = F.coalesce("occurred_at", "created_at")
    counts = activities.groupBy(
        "owner_id", F.trunc(happened, "week").alias("week_start"), "activity_type"
    ).agg(F.count(F.lit(1)).alias("activity_count"))
    return with_owner_name(counts, owners).select(
        "owner_id", "owner_name", "week_start", "activity_type", "activity_count"
    )


def _contact_events(contacts: DataFrame) -> DataFrame:
    """Each contact as created and as worked on, from one scan."""

    def event(created: str, label: str) -> Column:
        return F.struct(
            F.col(created).alias("created_at"),
            F.col("last_modified_at"),
            F.lit(label).alias("activity_type"),
        )

    return contacts.select(
        "owner_id",
        F.inline(
            F.array(
                event("created_at", V.CATEGORY_CONTACT_CREATED),
                event("last_modified_at", V.CATEGORY_CONTACT_WORKED),
            )
        ),
    )


def _activity_events(activities: DataFrame) -> DataFrame:
    return with_activity_category(activities).select(
        "owner_id", "created_at", "last_modified_at", F.col("activity_category").alias("activity_type")
    )


def _deal_events(latest: DataFrame) -> DataFrame:
    return latest.select(
        "owner_id",
        "created_at",
        "last_modified_at",
        F.lit(V.CATEGORY_DEAL_CREATED).alias("activity_type"),
    )


def activity_volume_by_owner(
    activities: DataFrame, contacts: DataFrame, latest: DataFrame, owners: DataFrame
) -> DataFrame:
    """Classified activities, contacts and deals by owner, exact times and category."""
    events = (
        _activity_events(activities)
        .unionByName(_contact_events(contacts))
        .unionByName(_deal_events(latest))
    )
    counts = events.groupBy("owner_id", "created_at", "last_modified_at", "activity_type").agg(
        F.count(F.lit(1)).alias("activity_count")
    )
    return with_owner_name(counts, owners).select(
        "owner_id",
        "owner_name",
        "created_at",
        "last_modified_at",
        "activity_type",
        "activity_count",
    )


def near_period(config: SalesConfig) -> Column:
    """Whether a row is of a listed owner and was created in or near the weeks."""
    weeks = recent_weeks(config)
    allowed = F.col("owner_id").isin(list(config.owner_allow_list))
    near_dt = near_weeks_dt(F.col("dt"), weeks, 0 if config.strict_dt else 1)
    return allowed & near_weeks(F.col("created_at"), weeks, config.zone) & near_dt


def activity_volume_by_owner_type_last3weeks(
    activities: DataFrame,
    contacts: DataFrame,
    latest: DataFrame,
    owners: DataFrame,
    config: SalesConfig,
) -> DataFrame:
    """The same sources for the listed owners in the last three local weeks.

    Owner list, instants and partition dates are literals, so they reach the scans. The
    partition filter leaves a day on both sides, since local weeks end on another UTC day;
    ``strict_dt`` takes that day away.
    """
    if not config.owner_allow_list:
        raise ValueError("owner_allow_list names the owners to report on")
    weeks = recent_weeks(config)
    allowed = F.col("owner_id").isin(list(config.owner_allow_list))
    near = near_weeks(F.col("created_at"), weeks, config.zone)
    near_modified = near_weeks(F.col("last_modified_at"), weeks, config.zone)

    events = (
        _activity_events(activities.filter(near_period(config)))
        .unionByName(_contact_events(contacts.filter(allowed & (near | near_modified))))
        .unionByName(_deal_events(latest.filter(near_period(config))))
    )
    counts = (
        events.withColumn("week_start", local_week(F.col("created_at"), config.zone))
        .filter(in_weeks(F.col("week_start"), weeks))
        .groupBy("owner_id", "week_start", "activity_type")
        .agg(F.count(F.lit(1)).alias("activity_count"))
    )
    week = F.col("week_start")
    return with_owner_name(counts, owners).select(
        "owner_id",
        "owner_name",
        "week_start",
        week_end(week).alias("week_end"),
        long_week_label(week).alias("week_label_en"),
        "activity_type",
        "activity_count",
    )

"""Deal KPIs of the last three local weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope import vocabulary as V
from dealscope.config import SalesConfig
from dealscope.functions.calendar import (
    in_weeks,
    local_week,
    month_label,
    near_weeks,
    recent_weeks,
    short_week_label,
    spine,
    week_end,
)
from dealscope.operators.lookup import lookup
from dealscope.plans.monthly import kpi_rows

_EVENTS = {
    "opportunities_created": "op_detected_at",
    "proposals_sent": "proposal_sent_at",
    "closed_won": "closed_won_at",
}


def near_period(config: SalesConfig) -> Column:
    """Whether a deal has an event in or near the weeks."""
    weeks = recent_weeks(config)
    near = [near_weeks(F.col(column), weeks, config.zone) for column in _EVENTS.values()]
    return near[0] | near[1] | near[2]


def _week_events(clean: DataFrame, config: SalesConfig) -> DataFrame:
    """(owner_id, kpi, week_start) of the deal events within the weeks, in one pass.

    The week is computed from the event, so counting needs no range join to the calendar.
    """
    weeks = recent_weeks(config)
    events = F.array(
        *[
            F.struct(
                F.lit(kpi).alias("kpi"),
                local_week(F.col(column), config.zone).alias("week_start"),
            )
            for kpi, column in _EVENTS.items()
        ]
    )
    return (
        clean.filter(near_period(config))
        .select("owner_id", F.inline(events))
        .filter(in_weeks(F.col("week_start"), weeks))
    )


def _kpi_counts() -> list[Column]:
    return [F.count_if(F.col("kpi") == kpi).alias(kpi) for kpi in _EVENTS]


def _labels() -> list[Column]:
    week = F.col("week_start")
    return [week, week_end(week).alias("week_end"), short_week_label(week).alias("week_label")]


def deal_kpis_weekly_last3(clean: DataFrame, config: SalesConfig) -> DataFrame:
    """Opportunities, proposals and wins per week, zero-filled."""
    counts = _week_events(clean, config).groupBy("week_start").agg(*_kpi_counts())
    weeks = spine(clean.sparkSession, recent_weeks(config), "week_start")
    filled = weeks.join(counts, "week_start", "left").fillna(0, list(_EVENTS))
    return filled.select(*_labels(), *_EVENTS)


def deal_kpis_weekly_last3_by_owner(
    clean: DataFrame, owners: DataFrame, config: SalesConfig
) -> DataFrame:
    """The same per owner, with a row for every known owner and week."""
    weeks = recent_weeks(config)
    # One row per owner with its weeks' counts in an array: known owners are then joined
    # once, and no owners-by-weeks grid is shuffled.
    per_owner = (
        _week_events(clean, config)
        .groupBy("owner_id")
        .agg(
            F.array(
                *[
                    F.struct(
                        F.lit(week).alias("week_start"),
                        *[
                            F.count_if(
                                (F.col("kpi") == kpi) & (F.col("week_start") == F.lit(week))
                            ).alias(kpi)
                            for kpi in _EVENTS
                        ],
                    )
                    for week in weeks
                ]
            ).alias("weeks")
        )
    )
    no_events = F.array(
        *[
            F.struct(
                F.lit(week).alias("week_start"),
                *[F.lit(0).cast("bigint").alias(kpi) for kpi in _EVENTS],
            )
            for week in weeks
        ]
    )
    grid = lookup(owners.select("owner_id", "owner_name"), per_owner, "owner_id").select(
        "owner_id",
        F.coalesce("owner_name", "owner_id").alias("owner_name"),
        F.inline(F.coalesce("weeks", no_events)),
    )
    return grid.select("owner_id", "owner_name", *_labels(), *_EVENTS)


def deal_kpis_weekly_last3_transposed(weekly: DataFrame, config: SalesConfig) -> DataFrame:
    """Weekly KPIs as one row per week and KPI; week position 1 is the newest."""
    newest = F.lit(recent_weeks(config)[-1])
    rows = weekly.select(
        "week_start", "week_end", "week_label", F.inline(kpi_rows(V.WEEKLY_KPIS, "bigint"))
    )
    week = F.col("week_start")
    # The weeks follow each other without a gap, so the dense rank is a distance.
    position = (F.datediff(newest, week) / 7 + 1).cast("bigint")
    return rows.select(
        "week_start",
        "week_end",
        "week_label",
        "kpi_metric",
        "kpi_value",
        "value_type",
        "sort_order",
        F.year(week).alias("sort_year"),
        F.weekofyear(week).alias("sort_week"),
        month_label(week).alias("month_label"),
        position.alias("week_position"),
    )

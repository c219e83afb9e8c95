"""Monthly deal KPIs, each event counted in its own local month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope import vocabulary as V
from dealscope.config import SalesConfig
from dealscope.functions.calendar import (
    local_date,
    month_end,
    month_label,
    months_between,
    near_days,
    spine,
)


def _gap(start: Column, end: Column) -> Column:
    """Calendar days between two local dates; negative gaps do not count."""
    days = F.datediff(end, start)
    return F.when(days >= 0, days)


def deal_kpis_monthly_v2(clean: DataFrame, config: SalesConfig) -> DataFrame:
    """One row per month up to the current one: counts and average calendar-day gaps.

    One pass over the deals: each becomes up to four events, and the events are aggregated
    by month. Map-side aggregation leaves a few rows per task to shuffle.
    """
    times = {
        "op": "op_detected_at",
        "prep": "proposal_prep_at",
        "sent": "proposal_sent_at",
        "won": "closed_won_at",
    }
    last_day = month_end(config.as_of)
    near = [near_days(F.col(t), config.first_month, last_day, config.zone) for t in times.values()]
    # A documented win is exactly a deal with a won date, so the quality class adds nothing.
    days = clean.filter(near[0] | near[1] | near[2] | near[3]).select(
        *[
            local_date(F.col(column), config.zone).alias(name)
            for name, column in {"created": "created_at", **times}.items()
        ]
    )

    def event(name: str, day_column: str, gap: Column, cycle: Column | None = None) -> Column:
        no_cycle = F.lit(None).cast("int")
        return F.struct(
            F.lit(name).alias("event"),
            F.trunc(day_column, "month").alias("month_start"),
            gap.alias("gap"),
            (no_cycle if cycle is None else cycle).alias("cycle"),
        )

    no_gap = F.lit(None).cast("int")
    events = days.select(
        F.inline(
            F.array(
                event("op", "op", no_gap),
                event("prep", "prep", _gap(F.col("op"), F.col("prep"))),
                event("sent", "sent", _gap(F.col("prep"), F.col("sent"))),
                event(
                    "won",
                    "won",
                    _gap(F.col("sent"), F.col("won")),
                    _gap(F.col("created"), F.col("won")),
                ),
            )
        )
    )
    in_spine = F.col("month_start").between(F.lit(config.first_month), F.lit(last_day))

    def only(name: str, column: str) -> Column:
        return F.when(F.col("event") == name, F.col(column))

    kpis = (
        events.filter(in_spine)
        .groupBy("month_start")
        .agg(
            F.count_if(F.col("event") == "op").alias("opportunities_created"),
            F.count_if(F.col("event") == "sent").alias("proposals_sent"),
            F.count_if(F.col("event") == "won").alias("closed_won"),
            F.avg(only("prep", "gap")).alias("avg_op_to_prep_days"),
            F.avg(only("sent", "gap")).alias("avg_prep_to_sent_days"),
            F.avg(only("won", "gap")).alias("avg_sent_to_won_days"),
            F.avg(only("won", "cycle")).alias("avg_sales_cycle_days"),
        )
    )
    months = spine(
        clean.sparkSession, months_between(config.first_month, config.as_of), "month_start"
    )
    counts = ["opportunities_created", "proposals_sent", "closed_won"]
    return months.join(kpis, "month_start", "left").fillna(0, counts)


def kpi_rows(kpis: list[tuple[int, str, str, str]], value_type: str) -> Column:
    """Array of (sort_order, kpi_metric, kpi_value, value_type), one per KPI column."""
    return F.array(
        *[
            F.struct(
                F.lit(order).alias("sort_order"),
                F.lit(label).alias("kpi_metric"),
                F.col(column).cast(value_type).alias("kpi_value"),
                F.lit(kind).alias("value_type"),
            )
            for order, label, column, kind in kpis
        ]
    )


def deal_kpis_monthly_transposed(monthly: DataFrame) -> DataFrame:
    """Monthly KPIs as one row per month and KPI."""
    rows = monthly.select("month_start", F.inline(kpi_rows(V.MONTHLY_KPIS, "double")))
    return rows.select(
        "sort_order",
        "kpi_metric",
        "month_start",
        month_label(F.col("month_start")).alias("month_label"),
        "kpi_value",
        "value_type",
        F.year("month_start").alias("sort_year"),
        F.month("month_start").alias("sort_month"),
    )

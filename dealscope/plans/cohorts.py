"""Closing rates of monthly creation cohorts.

Cohorts and months are a handful of literals, so each view is one aggregation with a
conditional count per cell of the cohort matrix, whose row is then opened into the long
form. There is no grid to build by joins and no window for the running totals.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope import vocabulary as V
from dealscope.config import SalesConfig
from dealscope.functions.calendar import (
    cohort_month,
    cohorts,
    month_end,
    month_label,
    near_days,
)
from dealscope.operators.lookup import with_owner_name


def near_period(config: SalesConfig) -> Column:
    """Whether a deal was created in or near the cohort months."""
    months = cohorts(config)
    return near_days(F.col("created_at"), months[0], month_end(months[-1]), config.zone)


def _cohort_deals(latest: DataFrame, config: SalesConfig) -> DataFrame:
    """(owner_id, cohort_month, closed_month) of the deals created in a cohort month.

    The closing month is that of the win if it is one of the months, else of the loss.
    """
    months = cohorts(config)

    def month_of(column: str) -> Column:
        month = cohort_month(F.col(column), config)
        return F.when(month.between(F.lit(months[0]), F.lit(months[-1])), month)

    return (
        latest.filter(near_period(config))
        .select(
            "owner_id",
            month_of("created_at").alias("cohort_month"),
            F.coalesce(month_of("closed_won_at"), month_of("closed_lost_at")).alias("closed_month"),
        )
        .filter(F.col("cohort_month").isNotNull())
    )


def _matrix(deals: DataFrame, config: SalesConfig, *keys: str) -> DataFrame:
    """Long cohort matrix per key: cells of the months from each cohort's month on."""
    months = cohorts(config)
    cells = [(c, m) for c in months for m in months if m >= c]

    def total(c: date) -> str:
        return f"total_{c:%Y_%m}"

    def closed(c: date, m: date) -> str:
        return f"closed_{c:%Y_%m}_{m:%Y_%m}"

    counted = deals.groupBy(*keys).agg(
        *[F.expr(f"count_if(cohort_month = DATE '{c}') AS {total(c)}") for c in months],
        *[
            F.expr(
                f"count_if(cohort_month = DATE '{c}' AND closed_month = DATE '{m}')"
                f" AS {closed(c, m)}"
            )
            for c, m in cells
        ],
    )

    def cell(c: date, m: date) -> str:
        so_far = " + ".join(closed(c, x) for x in months if c <= x <= m)
        return (
            f"named_struct('cohort_month', DATE '{c}', 'month_start', DATE '{m}', "
            f"'total_deals', {total(c)}, 'closed_in_month', {closed(c, m)}, "
            f"'cumulative_closed', {so_far})"
        )

    long = counted.selectExpr(*keys, f"inline(array({', '.join(cell(c, m) for c, m in cells)}))")
    percent = F.col("cumulative_closed") * 100.0 / F.col("total_deals")
    if config.stepwise_percent:
        percent = F.round(percent.cast("decimal(20, 10)"), 1)
    percent = F.round(percent).cast("int")
    return long.withColumn(
        "cumulative_pct", F.when(F.col("total_deals") > 0, percent).otherwise(0)
    )


def deal_cohort_closing_rates(latest: DataFrame, config: SalesConfig) -> DataFrame:
    """Cohort by month: deals, closed in the month, closed so far, and percent."""
    return _matrix(_cohort_deals(latest, config), config)


def deal_cohort_closing_rates_by_owner(
    latest: DataFrame, owners: DataFrame, config: SalesConfig
) -> DataFrame:
    """The same for each owner who has a deal in any cohort."""
    deals = _cohort_deals(latest, config).filter(F.col("owner_id").isNotNull())
    return with_owner_name(_matrix(deals, config, "owner_id"), owners).select(
        "owner_id",
        "owner_name",
        "cohort_month",
        "month_start",
        month_label(F.col("cohort_month")).alias("cohort_label_en"),
        month_label(F.col("month_start")).alias("month_label_en"),
        "total_deals",
        "closed_in_month",
        "cumulative_closed",
        "cumulative_pct",
    )


def _matrix_labels() -> tuple[list[Column], list[Column]]:
    cohort, month = F.col("cohort_month"), F.col("month_start")
    labels = [
        F.concat(F.lit(V.COHORT_LABEL_PREFIX), month_label(cohort)).alias("cohort_label"),
        month_label(month).alias("month_label"),
    ]
    sorting = [
        F.year(cohort).alias("cohort_year"),
        F.month(cohort).alias("cohort_month_num"),
        F.year(month).alias("closing_year"),
        F.month(month).alias("closing_month_num"),
    ]
    return labels, sorting


def deal_cohort_closing_rates_transposed(rates: DataFrame) -> DataFrame:
    """Cohort matrix with row and column labels; the rates already have every cell."""
    labels, sorting = _matrix_labels()
    return rates.select("cohort_month", "month_start", *labels, "cumulative_pct", *sorting)


def deal_cohort_closing_rates_by_owner_transposed(rates: DataFrame) -> DataFrame:
    """Labelled cohort matrix per owner."""
    labels, sorting = _matrix_labels()
    return rates.select(
        "owner_id",
        "owner_name",
        "cohort_month",
        "month_start",
        *labels,
        "cumulative_pct",
        "total_deals",
        "cumulative_closed",
        *sorting,
    )

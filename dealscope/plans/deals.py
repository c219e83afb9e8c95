"""Deal views: latest row, close quality, company name, stage durations, monthly KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope import vocabulary as V
from dealscope.config import SalesConfig
from dealscope.functions.categories import deal_status_quality
from dealscope.functions.parsing import number
from dealscope.operators.dedupe import latest_per_key
from dealscope.operators.lookup import few_broadcast, lookup, with_owner_name
from dealscope.schemas import DEALS


def deals_latest(deals: DataFrame) -> DataFrame:
    """Latest row of each deal.

    Versions of a deal normally share ``created_at``; the later columns make the choice
    among them deterministic.
    """
    order = ["created_at", "last_modified_at", "dt", "deal_name"]
    return latest_per_key(
        deals.select(*DEALS.names), ["deal_id"], [F.desc_nulls_last(name) for name in order]
    )


def deals_latest_near(deals: DataFrame, near: Column) -> DataFrame:
    """Latest row of the deals of which any version meets ``near``.

    A view that filters latest rows by ``near`` gets from these what it gets from all: a deal
    without such a version has no such latest row either. The condition reaches the scan and
    reads its own columns only; the versions of the few deals it leaves are then ranked,
    instead of the whole history. Counting the candidates takes a job.
    """
    found = deals.filter(near).select(F.col("deal_id").alias("_near_id")).distinct()
    same = deals["deal_id"].eqNullSafe(F.col("_near_id"))
    return deals_latest(deals.join(few_broadcast(found), same, "left_semi"))


def deals_latest_clean(latest: DataFrame) -> DataFrame:
    """Latest deals with a class for how their close is documented."""
    quality = deal_status_quality(
        F.col("closed_at"), F.col("closed_won_at"), F.col("closed_lost_at")
    )
    return latest.withColumn("deal_status_quality", quality).withColumn(
        "has_data_quality_issue",
        (F.col("deal_status_quality") == V.QUALITY_NO_TRANSITION).cast("int"),
    )


def companies_latest(companies: DataFrame) -> DataFrame:
    """Latest row of each company."""
    order = ["last_modified_at", "created_at", "dt", "name"]
    return latest_per_key(companies, ["company_id"], [F.desc_nulls_last(name) for name in order])


def deals_with_company(latest: DataFrame, companies: DataFrame) -> DataFrame:
    """Latest deals with the name of their company; ``companies`` may hold old copies."""
    names = companies_latest(companies).select("company_id", F.col("name").alias("company_name"))
    return lookup(latest, names, "company_id").select(
        "deal_id",
        "deal_name",
        "company_id",
        "company_name",
        "owner_id",
        "deal_stage",
        "created_at",
        "closed_at",
        "amount",
        "op_detected_at",
        "proposal_prep_at",
        "proposal_sent_at",
        "closed_won_at",
        "closed_lost_at",
        "source",
        "dt",
    )


def _elapsed_days(start: str, end: str | Column) -> Column:
    """Whole days of 24 hours between two instants."""
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("DAY", F.col(start), end)


def with_durations(clean: DataFrame) -> DataFrame:
    """Deals with numeric amount, days between stages and whether they were won."""
    closed = F.coalesce("closed_won_at", "closed_lost_at")
    return clean.select(
        "deal_id",
        "deal_name",
        "owner_id",
        "created_at",
        "closed_at",
        "op_detected_at",
        "proposal_prep_at",
        "proposal_sent_at",
        "closed_won_at",
        "closed_lost_at",
        number(F.col("amount")).alias("amount"),
        _elapsed_days("created_at", "op_detected_at").alias("created_to_op_days"),
        _elapsed_days("op_detected_at", "proposal_prep_at").alias("op_to_prep_days"),
        _elapsed_days("proposal_prep_at", "proposal_sent_at").alias("prep_to_sent_days"),
        _elapsed_days("proposal_sent_at", "closed_won_at").alias("sent_to_won_days"),
        _elapsed_days("created_at", closed).alias("sales_cycle_days"),
        (F.col("deal_status_quality") == V.QUALITY_WON).alias("is_won"),
    )


def deal_stage_durations_per_deal(clean: DataFrame, owners: DataFrame) -> DataFrame:
    """Per deal: owner name, numeric amount and the days spent between stages."""
    named = with_owner_name(with_durations(clean), owners)
    first = ["deal_id", "deal_name", "owner_id", "owner_name"]
    return named.select(*first, *[name for name in named.columns if name not in first])


def deal_kpis_monthly(clean: DataFrame, owners: DataFrame, config: SalesConfig) -> DataFrame:
    """Deals, win rate, average durations and amount by UTC creation month and owner.

    Deals are aggregated by owner id before the owner's name is looked up, so the lookup
    sees one row per owner and month.
    """
    deals_won = F.count_if("is_won")
    win_rate = deals_won / F.count(F.lit(1))
    if config.integer_rate:
        win_rate = F.floor(win_rate)
    durations = {
        "avg_sales_cycle_days": "sales_cycle_days",
        "avg_created_to_op_days": "created_to_op_days",
        "avg_op_to_prep_days": "op_to_prep_days",
        "avg_prep_to_sent_days": "prep_to_sent_days",
        "avg_sent_to_won_days": "sent_to_won_days",
    }
    monthly = (
        with_durations(clean)
        .groupBy(F.trunc("created_at", "month").alias("month_start"), "owner_id")
        .agg(
            F.count(F.lit(1)).alias("deals_created"),
            deals_won.alias("deals_won"),
            win_rate.alias("win_rate"),
            *[F.avg(days).alias(name) for name, days in durations.items()],
            F.sum("amount").alias("total_amount"),
        )
    )
    return with_owner_name(monthly, owners).select(
        "month_start",
        "owner_id",
        "owner_name",
        "deals_created",
        "deals_won",
        "win_rate",
        *durations,
        "total_amount",
    )

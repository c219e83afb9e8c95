"""Monthly deal KPIs kept up to date by the sync job.

The KPIs are kept as parts that add up: counts, and sums with the number of their values, for
each creation date and owner, in one partition per month. A run replaces the parts of the
dates it changes, computed from the rows that the merge writes for them, and leaves all
others: its cost follows the change set, and a run that is repeated changes nothing more. The
view adds the parts up, so it reads one row per date and owner instead of the deals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.config import SalesConfig
from dealscope.functions.parsing import partition_date
from dealscope.operators.lookup import with_owner_name
from dealscope.operators.merge import stage
from dealscope.plans.deals import deals_latest_clean, with_durations
from dealscope.sources.curated import (
    overwrite_dataset,
    overwrite_partitions,
    read_curated,
    remove,
)

_DURATIONS = {
    "avg_sales_cycle_days": "sales_cycle_days",
    "avg_created_to_op_days": "created_to_op_days",
    "avg_op_to_prep_days": "op_to_prep_days",
    "avg_prep_to_sent_days": "prep_to_sent_days",
    "avg_sent_to_won_days": "sent_to_won_days",
}
_UNDATED = "undated"


def _month_of(dt: Column) -> Column:
    """Partition of a date; deals without a creation date have one of their own."""
    return F.coalesce(F.left(dt.cast("string"), F.lit(7)), F.lit(_UNDATED))


def monthly_parts(latest: DataFrame) -> DataFrame:
    """Parts of the KPIs by creation date and owner, of deals that occur once each.

    Amounts are added as decimals, so that their sum does not depend on the order.
    """
    rows = with_durations(deals_latest_clean(latest))
    amount = F.col("amount").cast("decimal(28,6)")
    return (
        rows.groupBy(partition_date(F.col("created_at")).alias("dt"), "owner_id")
        .agg(
            F.count(F.lit(1)).alias("deals_created"),
            F.count_if("is_won").alias("deals_won"),
            *[F.sum(days).alias(f"{days}_sum") for days in _DURATIONS.values()],
            *[F.count(days).alias(f"{days}_count") for days in _DURATIONS.values()],
            F.sum(amount).alias("amount_sum"),
        )
        .withColumn("month", _month_of(F.col("dt")))
    )


def build_monthly(latest: DataFrame, path: str) -> None:
    """Make the parts anew from a whole table of deals."""
    copy = f"{path}_incoming"
    overwrite_dataset(stage(monthly_parts(latest), copy), path, ["month"], stored=True)
    remove(latest.sparkSession, copy)


def has_monthly(spark: SparkSession, path: str) -> bool:
    return read_curated(spark, path) is not None


def refresh_monthly(changed: DataFrame, affected: DataFrame, path: str) -> None:
    """Replace the parts of the ``affected`` dates by those of their rows, ``changed``.

    An affected date without rows keeps an empty part, so that its month stays written.
    """
    spark = changed.sparkSession
    fresh = monthly_parts(changed)
    dates = affected.select(F.col("dt").cast("string").alias("dt")).distinct()
    empty = dates.select(
        *[
            F.col(c) if c == "dt" else F.lit(0).cast(t) if c.startswith("deals_")
            else F.lit(None).cast(t) if c != "month" else _month_of(F.col("dt")).alias(c)
            for c, t in ((f.name, f.dataType) for f in fresh.schema)
        ]
    ).toDF(*fresh.columns)
    stored = spark.read.schema(fresh.schema).parquet(path)
    months = F.broadcast(dates.select(_month_of(F.col("dt")).alias("month")).distinct())
    marked = dates.select(F.col("dt").alias("_dt"))
    others = stored.join(months, "month", "left_semi").join(
        F.broadcast(marked), stored["dt"].eqNullSafe(marked["_dt"]), "left_anti"
    )
    copy = f"{path}_incoming"
    rows = others.select(*fresh.columns).unionByName(fresh).unionByName(empty)
    overwrite_partitions(stage(rows, copy), path, ["month"], stored=True)
    remove(spark, copy)


def deal_kpis_monthly_kept(parts: DataFrame, owners: DataFrame, config: SalesConfig) -> DataFrame:
    """``deal_kpis_monthly`` from the parts."""
    created, won = F.sum("deals_created"), F.sum("deals_won")
    win_rate = F.try_divide(won, created)  # an empty part alone has no deals
    if config.integer_rate:
        win_rate = F.floor(win_rate)
    monthly = (
        parts.groupBy(F.trunc(F.to_date("dt"), "month").alias("month_start"), "owner_id")
        .agg(
            created.alias("deals_created"),
            won.alias("deals_won"),
            win_rate.alias("win_rate"),
            *[
                F.try_divide(F.sum(f"{days}_sum"), F.sum(f"{days}_count")).alias(name)
                for name, days in _DURATIONS.items()
            ],
            F.sum("amount_sum").cast("double").alias("total_amount"),
        )
        .filter("deals_created > 0")
    )
    return with_owner_name(monthly, owners).select(
        "month_start",
        "owner_id",
        "owner_name",
        "deals_created",
        "deals_won",
        "win_rate",
        *_DURATIONS,
        "total_amount",
    )


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """The stored parts."""
    found = read_curated(spark, path)
    if found is None:
        raise ValueError(f"no monthly parts at {path}")
    return found

"""Business calendar: local days, weeks and months of UTC timestamps.

Everything relative to "today" is computed on the driver from ``SalesConfig.as_of`` and
enters the plan as a literal, so filters on it prune partitions and row groups.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.config import SalesConfig


def local_timestamp(ts: Column, zone: str) -> Column:
    return F.from_utc_timestamp(ts, zone)


def local_date(ts: Column, zone: str) -> Column:
    return F.to_date(local_timestamp(ts, zone))


def local_week(ts: Column, zone: str) -> Column:
    """Monday of the local week."""
    return F.trunc(local_timestamp(ts, zone), "week")


def local_month(ts: Column, zone: str) -> Column:
    """First day of the local month."""
    return F.trunc(local_timestamp(ts, zone), "month")


def latest_sunday(day: Column) -> Column:
    """Latest Sunday on or before a date."""
    return F.date_sub(day, (F.weekday(day) + 1) % 7)


def cohort_month(ts: Column, config: SalesConfig) -> Column:
    """Month bucket of the cohort views.

    The "shifted" months start as many hours before UTC midnight as the zone is behind
    UTC, and leave out what lies after second 59 of their last minute.
    """
    if config.month_bounds == "local":
        return local_month(ts, config.zone)
    shifted = F.to_utc_timestamp(ts, config.zone)
    month = F.trunc(shifted, "month")
    last_second = F.add_months(month, 1).cast("timestamp") - F.expr("INTERVAL 1 SECOND")
    return F.when(shifted <= last_second, month)


def cohort_month_bounds(month: Column, zone: str) -> tuple[Column, Column]:
    """UTC start and (exclusive) end of a local month."""
    start = F.to_utc_timestamp(month.cast("timestamp"), zone)
    end = F.to_utc_timestamp(F.add_months(month, 1).cast("timestamp"), zone)
    return start, end


def add_months(month: date, count: int) -> date:
    index = month.year * 12 + month.month - 1 + count
    return date(index // 12, index % 12 + 1, 1)


def months_between(first: date, last: date) -> list[date]:
    """First days of the months from ``first`` to ``last``, both included."""
    count = (last.year - first.year) * 12 + last.month - first.month
    return [add_months(first, i) for i in range(count + 1)]


def cohorts(config: SalesConfig) -> list[date]:
    """Creation months of the cohort views, oldest first."""
    return [
        add_months(config.as_of, -back) for back in range(config.cohort_months - 1, -1, -1)
    ]


def recent_weeks(config: SalesConfig) -> list[date]:
    """Mondays of the last complete weeks, oldest first; a Sunday completes its own week."""
    sunday = config.as_of - timedelta(days=config.as_of.isoweekday() % 7)
    return [sunday - timedelta(days=6 + 7 * back) for back in range(config.weeks - 1, -1, -1)]


def local_midnight(day: date, zone: str) -> datetime:
    """UTC instant of local midnight."""
    return datetime.combine(day, time(), ZoneInfo(zone)).astimezone(timezone.utc)


def month_end(month: date) -> date:
    return add_months(month, 1) - timedelta(days=1)


def near_days(ts: Column, first: date, last: date, zone: str) -> Column:
    """Wide instant range around local days, with a day to spare on both sides.

    It is meant to be pushed down to the scan; the exact local date is filtered after it.
    """
    low = local_midnight(first - timedelta(days=1), zone)
    high = local_midnight(last + timedelta(days=2), zone)
    return ts.between(F.lit(low), F.lit(high))


def near_weeks(ts: Column, weeks: list[date], zone: str) -> Column:
    return near_days(ts, weeks[0], weeks[-1] + timedelta(days=6), zone)


def near_weeks_dt(dt: Column, weeks: list[date], slack_days: int) -> Column:
    """Partition filter on ``dt`` for the weeks; rows without ``dt`` stay."""
    low = weeks[0] - timedelta(days=slack_days)
    high = weeks[-1] + timedelta(days=6 + slack_days)
    return dt.isNull() | dt.between(low.isoformat(), high.isoformat())


def in_weeks(week: Column, weeks: list[date]) -> Column:
    return week.between(F.lit(weeks[0]), F.lit(weeks[-1]))


def spine(spark: SparkSession, days: list[date], name: str) -> DataFrame:
    """One row per date of a short literal list."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(day) for day in days])).alias(name))


def months_from_to(first: Column, last: Column) -> Column:
    """Array of the months from one date to another, both included."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))


def month_label(day: Column) -> Column:
    """``March 2025``"""
    return F.date_format(day, "MMMM yyyy")


def week_end(week: Column) -> Column:
    return F.date_add(week, 6)


def short_week_label(week: Column) -> Column:
    """``Mar 3 - Mar 9``"""
    return F.concat(
        F.date_format(week, "MMM d"), F.lit(" - "), F.date_format(week_end(week), "MMM d")
    )


def long_week_label(week: Column) -> Column:
    """``March 3 to March 9, 2025``"""
    return F.concat(
        F.date_format(week, "MMMM d"),
        F.lit(" to "),
        F.date_format(week_end(week), "MMMM d, yyyy"),
    )

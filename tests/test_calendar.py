from datetime import date

import pytest
from pyspark.sql import functions as F

from dealscope.config import SalesConfig
from dealscope.functions import calendar

from .frames import utc

ZONE = "America/Montevideo"


def one(spark, ts, function):
    df = spark.createDataFrame([(utc(ts),)], "ts timestamp")
    return df.select(function(F.col("ts")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("as_of", "newest"),
    [
        (date(2024, 1, 24), date(2024, 1, 15)),  # a Wednesday
        (date(2024, 1, 21), date(2024, 1, 15)),  # a Sunday completes its week
        (date(2024, 1, 22), date(2024, 1, 15)),  # a Monday
        (date(2024, 1, 20), date(2024, 1, 8)),  # a Saturday does not
    ],
)
def test_recent_weeks_end_on_the_latest_sunday(as_of, newest):
    weeks = calendar.recent_weeks(SalesConfig(as_of=as_of))
    assert weeks[-1] == newest
    assert [(b - a).days for a, b in zip(weeks, weeks[1:])] == [7, 7]


def test_cohorts_cross_the_year():
    assert calendar.cohorts(SalesConfig(as_of=date(2024, 2, 29)))[0] == date(2023, 9, 1)


def test_local_day_edges(spark):
    # 23:30 and 00:30 local around a Sunday night
    assert one(spark, "2024-01-22T02:30:00", lambda t: calendar.local_week(t, ZONE)) == date(
        2024, 1, 15
    )
    assert one(spark, "2024-01-22T03:30:00", lambda t: calendar.local_week(t, ZONE)) == date(
        2024, 1, 22
    )
    assert one(spark, "2024-02-01T02:59:59", lambda t: calendar.local_month(t, ZONE)) == date(
        2024, 1, 1
    )


@pytest.mark.parametrize(
    ("ts", "local", "shifted"),
    [
        ("2023-12-31T20:59:59.500", date(2023, 12, 1), None),  # the sub-second gap
        ("2023-12-31T20:59:59", date(2023, 12, 1), date(2023, 12, 1)),
        ("2023-12-31T21:00:00", date(2023, 12, 1), date(2024, 1, 1)),
        ("2024-01-01T02:59:59", date(2023, 12, 1), date(2024, 1, 1)),
        ("2024-01-01T03:00:00", date(2024, 1, 1), date(2024, 1, 1)),
    ],
)
def test_cohort_month_bounds(spark, ts, local, shifted):
    day = date(2024, 1, 24)
    for bounds, expected in (("local", local), ("shifted", shifted)):
        config = SalesConfig(as_of=day, month_bounds=bounds)
        assert one(spark, ts, lambda t: calendar.cohort_month(t, config)) == expected


def test_labels(spark):
    week = F.lit(date(2025, 3, 3))
    row = (
        spark.range(1)
        .select(
            calendar.short_week_label(week).alias("short"),
            calendar.long_week_label(week).alias("long"),
            calendar.month_label(week).alias("month"),
        )
        .first()
    )
    assert row["short"] == "Mar 3 - Mar 9"
    assert row["long"] == "March 3 to March 9, 2025"
    assert row["month"] == "March 2025"


def test_configuration_is_checked():
    with pytest.raises(ValueError):
        SalesConfig(as_of=date(2024, 1, 1), month_bounds="lunar")
    with pytest.raises(TypeError):
        SalesConfig(as_of=utc("2024-01-01T00:00:00"))

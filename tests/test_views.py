from datetime import date

import pytest

from dealscope.config import SalesConfig
from dealscope.plans import activities as A
from dealscope.plans import cohorts, deals, monthly, weekly
from dealscope.plans.views import VIEWS, ViewLayer
from dealscope.schemas import ACTIVITIES, COMPANIES, CONTACTS

from . import frames
from .frames import utc

CONFIG = SalesConfig(as_of=date(2024, 1, 24), first_month=date(2023, 11, 1))


def test_latest_row_is_deterministic(spark):
    d = frames.deals(
        spark,
        {"deal_id": "1", "created_at": "2024-01-01", "last_modified_at": "2024-01-02", "amount": "1"},
        {"deal_id": "1", "created_at": "2024-01-01", "last_modified_at": "2024-01-03", "amount": "2"},
        {"deal_id": "1", "created_at": "2024-01-01", "amount": "3"},
        {"deal_id": "2", "created_at": "2023-01-01", "last_modified_at": "2024-02-01", "amount": "4"},
        {"deal_id": "2", "created_at": "2023-06-01", "amount": "5"},
    )
    found = deals.deals_latest(d).collect()
    assert {r["deal_id"]: r["amount"] for r in found} == {"1": "2", "2": "5"}


def test_quality_classes(spark):
    d = frames.deals(
        spark,
        {"deal_id": "a", "closed_at": "2024-01-01"},
        {"deal_id": "b", "closed_won_at": "2024-01-01", "closed_lost_at": "2024-01-01"},
        {"deal_id": "c", "closed_lost_at": "2024-01-01"},
        {"deal_id": "d"},
    )
    found = {r["deal_id"]: r for r in deals.deals_latest_clean(d).collect()}
    assert {k: r["deal_status_quality"] for k, r in found.items()} == {
        "a": "has_close_date_no_stage_transition",
        "b": "properly_closed_won",
        "c": "properly_closed_lost",
        "d": "open",
    }
    assert [found[k]["has_data_quality_issue"] for k in "abcd"] == [1, 0, 0, 0]


def test_durations_count_whole_24_hour_days(spark):
    d = frames.deals(
        spark,
        {
            "deal_id": "1",
            "owner_id": "x",
            "created_at": "2024-01-01T12:00:00",
            "op_detected_at": "2024-01-02T11:00:00",  # next calendar day, 23 hours
            "proposal_prep_at": "2024-01-01T10:00:00",  # 25 hours back
            "closed_lost_at": "2024-01-11T12:00:00",
            "amount": "abc",
        },
    )
    clean = deals.deals_latest_clean(d)
    row = deals.deal_stage_durations_per_deal(clean, frames.owners(spark)).first()
    assert (row["created_to_op_days"], row["op_to_prep_days"]) == (0, -1)
    assert (row["sales_cycle_days"], row["sent_to_won_days"]) == (10, None)
    assert (row["owner_name"], row["amount"], row["is_won"]) == ("x", None, False)


def test_monthly_win_rate_options(spark):
    d = frames.deals(
        spark,
        {"deal_id": "1", "created_at": "2024-01-01", "closed_won_at": "2024-01-05"},
        {"deal_id": "2", "created_at": "2024-01-02"},
    )
    clean = deals.deals_latest_clean(d)
    owners = frames.owners(spark)
    whole = SalesConfig(as_of=CONFIG.as_of, integer_rate=True)
    row = deals.deal_kpis_monthly(clean, owners, CONFIG).first()
    assert (row["win_rate"], row["owner_name"], row["total_amount"]) == (0.5, None, None)
    assert deals.deal_kpis_monthly(clean, owners, whole).first()["win_rate"] == 0


def test_monthly_kpis_use_each_events_local_month(spark):
    d = frames.deals(
        spark,
        {
            "deal_id": "1",
            "created_at": "2023-12-20",
            "op_detected_at": "2024-01-01T02:00:00",  # still December locally
            "proposal_prep_at": "2023-12-30T12:00:00",  # before the opportunity: no gap
            "proposal_sent_at": "2024-01-03T12:00:00",
            "closed_won_at": "2024-01-10T12:00:00",
        },
    )
    found = monthly.deal_kpis_monthly_v2(deals.deals_latest_clean(d), CONFIG)
    rows = {r["month_start"]: r for r in found.collect()}
    assert sorted(rows) == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1)]
    december, january = rows[date(2023, 12, 1)], rows[date(2024, 1, 1)]
    assert (december["opportunities_created"], december["avg_op_to_prep_days"]) == (1, None)
    assert (january["proposals_sent"], january["avg_prep_to_sent_days"]) == (1, 4.0)
    assert (january["closed_won"], january["avg_sent_to_won_days"]) == (1, 7.0)
    assert january["avg_sales_cycle_days"] == 22.0  # from the 19th, locally
    assert rows[date(2023, 11, 1)]["opportunities_created"] == 0
    assert monthly.deal_kpis_monthly_transposed(found).count() == 21


def test_weekly_kpis(spark):
    d = frames.deals(
        spark,
        {"deal_id": "1", "owner_id": "o", "op_detected_at": "2024-01-22T02:30:00"},  # Sunday
        {"deal_id": "2", "owner_id": "o", "op_detected_at": "2024-01-22T03:30:00"},  # Monday
        {"deal_id": "3", "owner_id": "gone", "closed_won_at": "2024-01-01T03:00:00"},
        {"deal_id": "4", "proposal_sent_at": "2024-01-01T02:59:00"},  # the Sunday before
    )
    clean = deals.deals_latest_clean(d)
    found = weekly.deal_kpis_weekly_last3(clean, CONFIG)
    counts = {
        r["week_start"]: (r["opportunities_created"], r["proposals_sent"], r["closed_won"])
        for r in found.collect()
    }
    assert counts == {
        date(2024, 1, 1): (0, 0, 1),
        date(2024, 1, 8): (0, 0, 0),
        date(2024, 1, 15): (1, 0, 0),
    }
    owners = frames.owners(spark, ("o", "Ona"), ("p", None))
    by_owner = weekly.deal_kpis_weekly_last3_by_owner(clean, owners, CONFIG).collect()
    assert len(by_owner) == 6
    assert sum(r["opportunities_created"] for r in by_owner) == 1
    assert sum(r["closed_won"] for r in by_owner) == 0
    assert {r["owner_name"] for r in by_owner} == {"Ona", "p"}
    long = weekly.deal_kpis_weekly_last3_transposed(found, CONFIG).collect()
    assert len(long) == 9
    assert {(r["week_start"], r["week_position"]) for r in long} == {
        (date(2024, 1, 1), 3),
        (date(2024, 1, 8), 2),
        (date(2024, 1, 15), 1),
    }


def test_cohorts(spark):
    d = frames.deals(
        spark,
        {"deal_id": "1", "owner_id": "o", "created_at": "2023-12-05", "closed_won_at": "2023-12-20"},
        {"deal_id": "2", "owner_id": "o", "created_at": "2023-12-06", "closed_lost_at": "2024-01-02T12:00:00"},
        # won outside the months, so the loss counts
        {"deal_id": "3", "created_at": "2023-12-07", "closed_won_at": "2025-01-01", "closed_lost_at": "2023-12-30"},
        # closed before it was created: in the total only
        {"deal_id": "4", "owner_id": "q", "created_at": "2024-01-05", "closed_won_at": "2023-11-11"},
        {"deal_id": "5", "owner_id": "o", "created_at": "2020-01-05"},
    )
    rates = cohorts.deal_cohort_closing_rates(d, CONFIG)
    rows = {(r["cohort_month"], r["month_start"]): r for r in rates.collect()}
    assert len(rows) == 21
    first = rows[date(2023, 12, 1), date(2023, 12, 1)]
    last = rows[date(2023, 12, 1), date(2024, 1, 1)]
    assert (first["total_deals"], first["closed_in_month"], first["cumulative_pct"]) == (3, 2, 67)
    assert (last["closed_in_month"], last["cumulative_closed"], last["cumulative_pct"]) == (1, 3, 100)
    january = rows[date(2024, 1, 1), date(2024, 1, 1)]
    assert (january["total_deals"], january["cumulative_pct"]) == (1, 0)
    for (cohort, month), row in rows.items():
        assert 0 <= row["cumulative_pct"] <= 100
        before = rows.get((cohort, date(2023, 12, 1)))
        if before and month > date(2023, 12, 1):
            assert row["cumulative_pct"] >= before["cumulative_pct"]

    owners = frames.owners(spark, ("o", "Ona"))
    by_owner = cohorts.deal_cohort_closing_rates_by_owner(d, owners, CONFIG)
    assert by_owner.count() == 42
    assert {(r["owner_id"], r["owner_name"]) for r in by_owner.collect()} == {
        ("o", "Ona"),
        ("q", "q"),
    }


def test_views_of_no_deals(spark):
    none = frames.deals(spark, {"deal_id": "1"}).limit(0)
    owners = frames.owners(spark, ("o", "Ona"))
    clean = deals.deals_latest_clean(deals.deals_latest(none))
    assert monthly.deal_kpis_monthly_v2(clean, CONFIG).count() == 3
    assert weekly.deal_kpis_weekly_last3(clean, CONFIG).count() == 3
    assert weekly.deal_kpis_weekly_last3_by_owner(clean, owners, CONFIG).count() == 3
    rates = cohorts.deal_cohort_closing_rates(clean, CONFIG).collect()
    assert len(rates) == 21
    assert {r["cumulative_pct"] for r in rates} == {0}
    assert cohorts.deal_cohort_closing_rates_by_owner(clean, owners, CONFIG).count() == 0


def test_company_names_do_not_fan_out(spark):
    companies = spark.createDataFrame(
        [
            ("c", "Old", utc("2024-01-01"), utc("2024-01-01"), "2024-01-01"),
            ("c", "New", utc("2024-01-01"), utc("2024-01-09"), "2024-01-09"),
        ],
        COMPANIES,
    )
    d = frames.deals(
        spark, {"deal_id": "1", "company_id": "c"}, {"deal_id": "2", "company_id": "gone"}, {"deal_id": "3"}
    )
    found = deals.deals_with_company(d, companies).collect()
    assert {r["deal_id"]: r["company_name"] for r in found} == {"1": "New", "2": None, "3": None}


def _activity(spark, *rows):
    data = []
    for i, row in enumerate(rows):
        created = utc(row.get("created_at", "2024-01-10"))
        full = {"activity_id": str(i), "owner_id": "1", "dt": f"{created:%Y-%m-%d}", **row}
        full["created_at"] = full["last_modified_at"] = created
        data.append(tuple(full.get(name) for name in ACTIVITIES.names))
    return spark.createDataFrame(data, ACTIVITIES)


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        ({"activity_type": "call"}, "Call"),
        ({"activity_type": "EMAIL"}, "Email sent to contact"),
        ({"activity_type": "EMAIL", "email_direction": "incoming_email"}, "Email reply from contact"),
        ({"activity_type": "whats app"}, "WhatsApp"),
        ({"activity_type": "NOTE"}, "Note"),
        ({"activity_type": "NOTE", "note_body": "whatsapp", "communication_body": "LinkedIn"}, "LinkedIn Message"),
        ({"activity_type": "Postal", "communication_source": "WhatsApp bridge"}, "WhatsApp"),
        ({"activity_type": "Postal"}, "Postal"),
        ({}, "Unknown"),
    ],
)
def test_activity_categories(spark, row, expected):
    found = A.with_activity_category(_activity(spark, row)).first()
    assert found["activity_category"] == expected


def test_last_weeks_keep_late_sunday_unless_strict(spark):
    activities = _activity(
        spark,
        {"activity_type": "CALL", "created_at": "2024-01-22T02:00:00"},  # Sunday 23:00 local
        {"activity_type": "CALL", "created_at": "2024-01-22T04:00:00"},
        {"activity_type": "CALL", "owner_id": "2"},
    )
    contacts = spark.createDataFrame([], CONTACTS)
    none = frames.deals(spark, {"deal_id": "1"}).limit(0)
    owners = frames.owners(spark, ("1", "Ana"))
    for strict, count in ((False, 1), (True, 0)):
        config = SalesConfig(as_of=CONFIG.as_of, owner_allow_list=("1",), strict_dt=strict)
        found = A.activity_volume_by_owner_type_last3weeks(
            activities, contacts, none, owners, config
        ).collect()
        assert len(found) == count
    with pytest.raises(ValueError):
        A.activity_volume_by_owner_type_last3weeks(activities, contacts, none, owners, CONFIG)


def test_weekly_activities_prefer_occurred_at(spark):
    from pyspark.sql import functions as F

    activities = _activity(spark, {"activity_type": "CALL"})
    moved = activities.withColumn("occurred_at", F.lit(utc("2024-01-02")))
    owners = frames.owners(spark)
    weeks = [
        A.activity_volume_by_owner_type_weekly(df, owners).first()["week_start"]
        for df in (activities, moved)
    ]
    assert weeks == [date(2024, 1, 8), date(2024, 1, 1)]


def test_all_views_register_in_sql(spark):
    tables = {
        "deals": frames.deals(spark, {"deal_id": "1", "created_at": "2024-01-01"}),
        "owners": frames.owners(spark, ("1", "Ana")),
        "activities": _activity(spark, {"activity_type": "CALL"}),
        "contacts": spark.createDataFrame([], CONTACTS),
        "companies": spark.createDataFrame([], COMPANIES),
    }
    config = SalesConfig(as_of=CONFIG.as_of, owner_allow_list=("1",))
    ViewLayer(spark, tables, config).register()
    for name in VIEWS:
        assert spark.table(name).columns
    assert spark.sql("SELECT count(*) AS n FROM deals_latest").first()["n"] == 1


def test_presentation_order(spark):
    d = frames.deals(
        spark,
        {"deal_id": "1", "owner_id": "b", "created_at": "2024-01-01"},
        {"deal_id": "2", "owner_id": "a", "created_at": "2024-01-01"},
        {"deal_id": "3", "created_at": "2024-01-01"},
        {"deal_id": "4", "owner_id": "a", "created_at": "2024-02-01"},
    )
    layer = ViewLayer(spark, {"deals": d, "owners": frames.owners(spark)}, CONFIG)
    found = layer.presented("deal_kpis_monthly").collect()
    assert [(r["month_start"].month, r["owner_name"]) for r in found] == [
        (2, "a"),
        (1, "a"),
        (1, "b"),
        (1, None),
    ]

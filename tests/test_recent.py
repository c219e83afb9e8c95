"""Views over recent periods that look for their deals first."""

import re
from dataclasses import replace

import pytest

from dealscope import adapter
from dealscope.operators import lookup
from dealscope.plans.views import RECENT, VIEWS, ViewLayer
from dealscope.schemas import DEALS
from dealscope.session import fresh_path
from dealscope.sources.curated import overwrite_dataset, read_curated

from . import frames
from .test_plan_shapes import FOLDER, physical

READ = sorted(
    name
    for name, (_, inputs) in VIEWS.items()
    if name in RECENT or any(i in RECENT for i in inputs)
)


@pytest.fixture(scope="module")
def tables(spark):
    path = fresh_path(spark, "deals")
    overwrite_dataset(adapter.deals(spark, FOLDER), path)
    return {**adapter.tables(spark, FOLDER), "deals": read_curated(spark, path, DEALS)}


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("most", [0, 10**6])
def test_same_rows_as_from_the_whole_history(spark, tables, monkeypatch, most):
    monkeypatch.setattr(lookup.few_broadcast, "__defaults__", (most,))
    plain = ViewLayer(spark, tables, adapter.CONFIG)
    narrow = ViewLayer(spark, tables, adapter.CONFIG, narrow_first=True)
    assert len(READ) == 8
    for name in READ:
        assert rows(narrow.frame(name)) == rows(plain.frame(name)), name


def test_filter_is_pushed_below_the_window(spark, tables):
    layer = ViewLayer(spark, tables, adapter.CONFIG, narrow_first=True)
    for name, column in (
        ("deal_kpis_weekly_last3", "op_detected_at"),
        ("deal_cohort_closing_rates", "created_at"),
        ("activity_volume_by_owner_type_last3weeks_v3", "created_at"),
    ):
        plan = physical(layer.frame(name))
        window = plan.index("WindowGroupLimit")
        semi = plan.index("LeftSemi", window)
        scans = re.findall(r"PushedFilters: (.*?), ReadSchema: (\S+)", plan[semi:])
        pushed = [(f, s) for f, s in scans if f"GreaterThanOrEqual({column}" in f]
        assert pushed and all("deal_name" not in s for _, s in pushed), name
        assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_a_deal_without_id_and_versions_that_left_the_period(spark):
    week = {"op_detected_at": "2024-01-10T12:00"}
    deals = frames.deals(
        spark,
        {"deal_id": "1", "created_at": "2023-01-01", "last_modified_at": "2023-01-01", **week},
        {"deal_id": "1", "created_at": "2023-01-01", "last_modified_at": "2023-02-01"},
        {"deal_id": "2", "created_at": "2023-01-01", "last_modified_at": "2023-01-01"},
        {"deal_id": "2", "created_at": "2023-01-01", "last_modified_at": "2023-02-01", **week},
        {"deal_id": None, "created_at": "2023-01-01", **week},
    )
    counts = []
    for narrow in (False, True):
        layer = ViewLayer(spark, {"deals": deals}, adapter.CONFIG, narrow_first=narrow)
        counts.append(rows(layer.frame("deal_kpis_weekly_last3")))
    assert counts[0] == counts[1] and "opportunities_created=2" in "".join(counts[0])


def test_a_table_of_latest_deals_is_used_as_it_is(spark, tables):
    layer = ViewLayer(spark, tables, replace(adapter.CONFIG), narrow_first=True)
    layer.materialize("deals_latest")
    assert "LeftSemi" not in physical(layer.frame("deal_kpis_weekly_last3"))

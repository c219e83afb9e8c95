"""What the plans have to look like to hold at a larger scale."""

from datetime import date

from pyspark.sql import functions as F

from dealscope import adapter
from dealscope.config import SalesConfig
from dealscope.plans import activities as A
from dealscope.plans import deals
from dealscope.plans.views import VIEWS, ViewLayer
from dealscope.schemas import ACTIVITIES, COMPANIES, CONTACTS, DEALS
from dealscope.session import fresh_path
from dealscope.sources.curated import overwrite_dataset, read_curated

from . import frames

FOLDER = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_shrink_before_the_shuffle(spark):
    plan = physical(deals.deals_latest(adapter.deals(spark, FOLDER)))
    before_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_exchange
    assert plan.count("Exchange hashpartitioning") == 1


def test_hot_company_is_split(spark, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__enabled="false",
    )
    n = 40_000
    rows = spark.range(n).repartition(8)
    company = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    filled = {
        "company_id": company,
        "deal_id": F.col("id").cast("string"),
        "deal_name": F.sha2(F.col("id").cast("string"), 256),  # does not compress
    }
    latest = rows.select(
        *[
            filled.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in DEALS.fields
        ]
    )
    companies = rows.select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("company_id"),
        F.concat(F.lit("name "), F.col("id")).alias("name"),
        *[F.lit(None).cast(COMPANIES[c].dataType).alias(c) for c in COMPANIES.names[2:]],
    )
    found = deals.deals_with_company(latest, companies)
    named = found.groupBy().agg(
        F.count(F.lit(1)), F.count("company_name"), F.count_distinct("deal_name")
    )
    assert tuple(named.collect()[0]) == (n, n - n // 3, n)
    assert "skew=true" in physical(named)


def test_small_dimensions_are_broadcast_and_large_ones_not(spark, settings):
    layer = ViewLayer(spark, adapter.tables(spark, FOLDER), adapter.CONFIG)
    assert "BroadcastHashJoin" in physical(layer.frame("deal_stage_durations_per_deal"))
    settings(autoBroadcastJoinThreshold="-1")
    layer = ViewLayer(spark, adapter.tables(spark, FOLDER), adapter.CONFIG)
    for name in VIEWS:
        if "_by_owner" in name or "per_deal" in name or "company" in name:
            assert "BroadcastHashJoin" not in physical(layer.frame(name)), name


def test_no_view_has_a_nested_loop_or_python(spark):
    layer = ViewLayer(spark, adapter.tables(spark, FOLDER), adapter.CONFIG)
    for name in VIEWS:
        plan = physical(layer.frame(name))
        for operator in ("NestedLoop", "CartesianProduct", "Python", "Pandas"):
            assert operator not in plan, name


def test_one_pass_over_the_deals(spark):
    layer = ViewLayer(spark, adapter.tables(spark, FOLDER), adapter.CONFIG)
    for name in VIEWS:
        if name.startswith("deal"):
            assert physical(layer.frame(name)).count("orders.parquet") == 1, name


def test_last_weeks_prune_partitions_and_columns(spark):
    path = fresh_path(spark, "activities")
    overwrite_dataset(adapter.activities(spark, FOLDER), path)
    config = SalesConfig(as_of=date(2024, 1, 24), owner_allow_list=("1",))
    found = A.activity_volume_by_owner_type_last3weeks(
        read_curated(spark, path, ACTIVITIES),
        spark.createDataFrame([], CONTACTS),
        frames.deals(spark, {"deal_id": "1"}).limit(0),
        frames.owners(spark),
        config,
    )
    scan = next(line for line in physical(found).splitlines() if "FileScan" in line)
    partition_filters = scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert "2023-12-31" in partition_filters
    assert "2024-01-22" in partition_filters
    pushed = scan[scan.index("PushedFilters") :]
    assert "owner_id" in pushed
    assert "task_subject" not in scan


def test_only_new_landings_are_scanned(spark):
    from dealscope.sources.raw import read_raw_objects

    path = fresh_path(spark, "raw")
    rows = [('{"id": "1"}', "2024-01-01"), ('{"id": "2"}', "2024-01-02")]
    frame = spark.createDataFrame(rows, "value string, landed string")
    frame.write.partitionBy("landed").text(path)
    found = read_raw_objects(spark, path, "contacts", landed_since="2024-01-02")
    scan = next(line for line in physical(found).splitlines() if "FileScan" in line)
    assert "2024-01-02" in scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert [r["id"] for r in found.collect()] == ["2"]


def test_shuffles_are_sized_by_the_input(spark, settings, monkeypatch):
    from dealscope import session

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    settings(adaptive__coalescePartitions__initialPartitionNum="4")
    session.size_shuffles(spark, FOLDER)
    assert spark.conf.get(key) == "4"
    monkeypatch.setattr(session, "_stored_bytes", lambda *_: 100 * 10**9)
    session.size_shuffles(spark, FOLDER)
    assert spark.conf.get(key) == "1490"
    monkeypatch.setattr(session, "_stored_bytes", lambda *_: 100 * 10**12)
    session.size_shuffles(spark, FOLDER)
    assert spark.conf.get(key) == "1490116"


def test_a_maintained_latest_table_is_filtered_at_the_scan(spark):
    path = fresh_path(spark, "deals_latest")
    deals.deals_latest(adapter.deals(spark, FOLDER)).write.parquet(path)
    tables = {**adapter.tables(spark, FOLDER), "deals_latest": read_curated(spark, path, DEALS)}
    layer = ViewLayer(spark, tables, adapter.CONFIG)
    for name in ("deal_kpis_monthly_v2", "deal_kpis_weekly_last3", "deal_cohort_closing_rates"):
        plan = physical(layer.frame(name))
        scan = next(line for line in plan.splitlines() if "FileScan" in line)
        assert "GreaterThanOrEqual(" in scan[scan.index("PushedFilters") :], name
        assert "Window" not in plan, name
        assert "deal_name" not in scan, name


def test_changes_and_bands_reach_the_scan_without_joins(spark):
    from dealscope.operators.changes import SyncWindow, select_changes
    from dealscope.plans.dashboard import quartile_band

    path = fresh_path(spark, "deals")
    adapter.deals(spark, FOLDER).write.parquet(path)
    rows = read_curated(spark, path, DEALS)
    window = SyncWindow(True, frames.utc("2024-01-01"), frames.utc("2024-01-01"))
    times = F.col("created_at"), F.col("last_modified_at")
    plan = physical(select_changes(rows, *times, window, frames.utc("2024-01-24")))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "Or(And(GreaterThanOrEqual(created_at" in scan[scan.index("PushedFilters") :]

    banded = quartile_band(rows.groupBy("owner_id").agg(F.count("*").alias("n")), "n")
    assert "NestedLoop" not in physical(banded)
    assert "CartesianProduct" not in physical(banded)

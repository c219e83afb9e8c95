"""Records beside a table, landing marks, and KPIs kept up to date."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from dealscope.adapter import CONFIG
from dealscope.operators import merge
from dealscope.operators.merge import full_load, merge_upsert
from dealscope.operators.state import get_landing_mark
from dealscope.plans import upkeep
from dealscope.plans.deals import deal_kpis_monthly, deals_latest, deals_latest_clean
from dealscope.plans.jobs import sync_landed, sync_table
from dealscope.schemas import DEALS
from dealscope.session import fresh_path
from dealscope.sources import curated

from . import frames
from .frames import utc
from .test_jobs import deal, lines
from .test_merge import rows, table


def no_merged_footers(monkeypatch, spark):
    """Fail when a read merges the schemas of all files."""
    reader = type(spark.read)
    option = reader.option

    def checked(self, key, value):
        assert key != "mergeSchema"
        return option(self, key, value)

    monkeypatch.setattr(reader, "option", checked)


def test_merge_reads_the_recorded_schema(spark, monkeypatch):
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "d1"), ("2", "b", "d2")), path)
    merge_upsert(rows(spark, ("2", "B", "d2")).withColumn("new", F.lit(1)), path, "id")
    with monkeypatch.context() as patch:
        no_merged_footers(patch, spark)
        merge_upsert(rows(spark, ("1", "A", "d1")), path, "id")
    assert curated.recorded_schema(spark, path).names == ["id", "v", "dt", "new"]
    found = spark.read.option("mergeSchema", True).parquet(path).orderBy("id").collect()
    assert [(r["id"], r["v"], r["new"]) for r in found] == [("1", "A", None), ("2", "B", 1)]


def test_moved_and_repeated_rows_are_found_without_a_scan_for_keys(spark, monkeypatch):
    path = fresh_path(spark, "t")
    full_load(rows(spark, *[(str(i), "a", f"d{i % 7}") for i in range(40)]), path)
    asked = []
    found = merge._partitions_with_keys

    def watched(locations, *rest):
        asked.append(locations.inputFiles())
        return found(locations, *rest)

    monkeypatch.setattr(merge, "_partitions_with_keys", watched)
    expected = {str(i): ("a", f"d{i % 7}") for i in range(40)}
    rng = random.Random(4)
    for step in range(4):
        moved = {str(rng.randrange(45)): (f"v{step}", f"d{rng.randrange(9)}") for _ in range(9)}
        expected |= moved
        delta = [(k, *v) for k, v in moved.items()]
        merge_upsert(rows(spark, *delta, *delta[:3]), path, "id", global_key=True)
        assert table(spark, path) == sorted((k, *v) for k, v in expected.items())
    place = curated.locations_path(path)
    assert all(place in file for files in asked for file in files) and all(asked)
    full_load(rows(spark, ("1", "z", "e1")), path)
    assert not os.path.exists(place)
    merge_upsert(rows(spark, ("1", "y", "e2")), path, "id", global_key=True)
    assert table(spark, path) == [("1", "y", "e2")]


def test_rows_written_beside_a_merge_are_found(spark):
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "d1")), path)
    merge_upsert(rows(spark, ("2", "b", "d1")), path, "id", global_key=True)
    curated.overwrite_partitions(rows(spark, ("3", "c", "d3"), ("4", "c", "d3")), path)
    merge_upsert(rows(spark, ("3", "d", "d4")), path, "id", global_key=True)
    assert table(spark, path) == [("1", "a", "d1"), ("2", "b", "d1"), ("3", "d", "d4"), ("4", "c", "d3")]


@pytest.mark.parametrize("limit", [3, 1000])
def test_partitions_are_dealt_to_tasks_by_size(spark, monkeypatch, limit):
    path = fresh_path(spark, "t")
    day = F.when(F.col("id") < 60, F.col("id")).when(F.col("id") < 90, 100)
    big = spark.range(100).select(
        F.col("id").cast("string"), F.lit("v").alias("v"), day.cast("string").alias("dt")
    )
    dealt = curated.dealt_by_size(big, ["dt"], limit)
    cores = spark.sparkContext.defaultParallelism
    assert dealt.rdd.getNumPartitions() == max(2 * cores, -(-100 // limit))
    where = dealt.select("dt", F.spark_partition_id().alias("task")).distinct().groupBy("dt").count()
    tasks = {r["dt"]: r["count"] for r in where.collect()}
    assert sorted(r["id"] for r in dealt.collect()) == sorted(str(i) for i in range(100))
    assert all(n == 1 for dt, n in tasks.items() if dt not in ("100", None))
    assert (tasks["100"] > 3 and tasks[None] > 1) if limit == 3 else tasks["100"] == 1
    curated.overwrite_dataset(big, path, stored=True)
    assert curated.read_curated(spark, path).count() == 100


def test_a_hot_partition_is_spread_evenly_without_a_join_by_shuffle(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")  # as if the counts' size were overrated
    day = F.when(F.col("id") < 10_000, "d").otherwise("e")
    one_day = spark.range(10_000).select("id", day.alias("dt"))
    dealt = curated.dealt_by_size(one_day, ["dt"], 500)
    assert dealt.rdd.getNumPartitions() == 20
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    tasks = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 20 and max(r["count"] for r in tasks) < 650


# --- modes that agree --------------------------------------------------------------------


def synced(spark, batches, now, incremental):
    """Rows after a run for each batch; every run sees all objects so far."""
    path, state = fresh_path(spark, "deals"), fresh_path(spark, "state")
    seen = []
    for batch, day in zip(batches, now, strict=True):
        seen += batch
        sync_table("deals", lines(spark, "deals", *seen), path, state, utc(day), incremental)
    found = spark.read.schema(DEALS).parquet(path)
    return sorted((r["deal_id"], r["deal_name"], str(r["last_modified_at"])) for r in found.collect())


def test_full_and_incremental_runs_end_with_the_same_rows(spark):
    old = "2023-05-01T00:00:00Z"
    batches = [
        [
            deal(1, old, "2030-01-01T00:00:00Z", "future"),
            deal(2, old, old, "kept"),
            deal(3, old, "2024-01-03T00:00:00Z", "newer"),
            deal(5, "2024-01-20T00:00:00Z", "2024-01-20T00:00:00Z", "not due"),
        ],
        [
            deal(1, old, "2024-01-09T00:00:00Z", "day before"),
            deal(2, old, "2031-01-01T00:00:00Z", "future too"),
            deal(3, old, "2024-01-02T23:30:00Z", "older"),
            deal(4, "2024-01-09T00:00:00Z", None, "new"),
        ],
        [deal(2, old, "2024-01-21T00:00:00Z", "later"), deal(6, old, "2024-01-21T00:00:00Z", "six")],
    ]
    days = ["2024-01-04", "2024-01-10", "2024-01-22"]
    full = synced(spark, batches, days, False)
    assert synced(spark, batches, days, True) == full
    assert [r[1] for r in full] == ["future", "future too", "newer", "new", "not due", "six"]


def land(spark, folder, day, *objects):
    os.makedirs(f"{folder}/landed={day}", exist_ok=True)
    with open(f"{folder}/landed={day}/{len(objects)}.json", "a") as file:
        file.writelines(o + "\n" for o in objects)


def test_incremental_runs_scan_new_landings_only(spark, monkeypatch):
    from dealscope.plans import jobs

    folder, path, state = (fresh_path(spark, x) for x in ("raw", "deals", "state"))
    scans = []
    read = jobs.read_raw_objects

    def watched(*args, **options):
        found = read(*args, **options)
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans.append((plan, found))
        return found

    monkeypatch.setattr(jobs, "read_raw_objects", watched)
    land(spark, folder, "2024-01-01", deal(1, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", "a"))
    land(
        spark, folder, "2024-01-02",
        deal(2, "2024-01-02T00:00:00Z", "2024-01-02T00:00:00Z", "b"),
        deal(9, "2024-01-06T00:00:00Z", "2024-01-06T00:00:00Z", "not due"),
    )
    assert sync_landed("deals", spark, folder, path, state, utc("2024-01-03")) == 2
    assert get_landing_mark(spark, state, "deals") == "2024-01-02"
    land(spark, folder, "2024-01-05", deal(1, "2024-01-01T00:00:00Z", "2024-01-04T00:00:00Z", "A"))
    for _ in range(2):
        sync_landed("deals", spark, folder, path, state, utc("2024-01-05"), overlap_days=0)
    assert get_landing_mark(spark, state, "deals") == "2024-01-05"
    # The version that was not due yet comes in later, though its folder is not read again.
    land(spark, folder, "2024-01-08", deal(3, "2024-01-07T00:00:00Z", "2024-01-07T00:00:00Z", "c"))
    sync_landed("deals", spark, folder, path, state, utc("2024-01-08"), overlap_days=0)
    found = spark.read.schema(DEALS).parquet(path).collect()
    assert sorted((r["deal_id"], r["deal_name"]) for r in found) == [
        ("1", "A"), ("2", "b"), ("3", "c"), ("9", "not due"),
    ]
    plan, last = scans[-1]
    assert "PartitionFilters" in plan and "landed" in plan[plan.index("PartitionFilters") :]
    assert len(last.inputFiles()) >= 1 and last.select("id").distinct().count() == 2
    assert glob.glob(f"{path}_*") == [f"{path}_waiting"]
    assert spark.read.parquet(f"{path}_waiting").count() == 0


# --- monthly KPIs ------------------------------------------------------------------------


def random_deal(rng, number):
    day = rng.randrange(1, 28)
    created = f"2024-0{rng.randrange(1, 5)}-{day:02d}T10:00:00Z"
    won = rng.random() < 0.5
    properties = {
        "dealname": f"d{number}",
        "createdate": created,
        "hubspot_owner_id": rng.choice(["1", "2", ""]),
        "amount": rng.choice(["10.25", "n/a", "7", "1000.1"]),
        "closedate": "2024-06-01T00:00:00Z" if won else "",
        "hs_v2_date_entered_closedwon": "2024-06-01T00:00:00Z" if won else "",
    }
    return {"id": str(number), "properties": properties}


def test_kept_kpis_equal_the_view_after_any_runs(spark):
    rng = random.Random(2)
    path, state, parts = (fresh_path(spark, x) for x in ("deals", "state", "parts"))
    owners = frames.owners(spark, ("1", "Ana"))
    known = {}
    for run in range(5):
        day = f"2024-07-{run + 1:02d}"
        changed = {k: random_deal(rng, k) for k in (rng.randrange(30) for _ in range(12))}
        for number, made in changed.items():
            if number in known:  # a deal's creation date stays
                made["properties"]["createdate"] = known[number]["properties"]["createdate"]
            made["properties"]["hs_lastmodifieddate"] = f"{day}T00:00:00Z"
        known |= changed
        raw = lines(spark, "deals", *map(json.dumps, known.values()))
        monthly = None if run == 1 else parts  # a run without upkeep, made up for later
        if run == 2:
            curated.remove(spark, parts)
        sync_table("deals", raw, path, state, utc(f"{day}T12:00"), run != 3, monthly)
        if monthly is None:
            continue
        table_now = deals_latest(spark.read.schema(DEALS).parquet(path))
        want = deal_kpis_monthly(deals_latest_clean(table_now), owners, CONFIG)
        got = upkeep.deal_kpis_monthly_kept(upkeep.read_monthly(spark, parts), owners, CONFIG)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert kpis_of(got) == kpis_of(want)


def kpis_of(df):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()),
        key=repr,
    )


def test_refresh_touches_the_months_of_the_change_only(spark):
    path = fresh_path(spark, "parts")
    base = frames.deals(
        spark,
        {"deal_id": "1", "created_at": "2024-01-05"},
        {"deal_id": "2", "created_at": "2024-02-05"},
        {"deal_id": "3"},
    )
    upkeep.build_monthly(base, path)
    untouched = glob.glob(f"{path}/month=2024-01/*.parquet")
    moved = base.filter("deal_id = '2'").limit(0)
    affected = spark.createDataFrame([("2024-02-05",), (None,)], "dt string")
    for _ in range(2):
        upkeep.refresh_monthly(moved.unionByName(base.filter("deal_id = '3'")), affected, path)
        assert glob.glob(f"{path}/month=2024-01/*.parquet") == untouched
        kept = upkeep.deal_kpis_monthly_kept(
            upkeep.read_monthly(spark, path), frames.owners(spark, ("1", "Ana")), CONFIG
        )
        assert sorted(str(r["month_start"]) for r in kept.collect()) == ["2024-01-01", "None"]

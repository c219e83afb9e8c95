import glob
from datetime import timezone

import pytest
from pyspark.sql import functions as F

from dealscope.operators import merge
from dealscope.operators.changes import (
    SyncWindow,
    changed_since,
    high_water_marks,
    later_mark,
    latest_changes,
    select_changes,
    sync_window,
)
from dealscope.operators.merge import full_load, merge_upsert
from dealscope.operators.state import get_sync_state, put_sync_state, read_sync_state
from dealscope.session import fresh_path
from dealscope.sources import catalog, curated

from .frames import utc

SCHEMA = "id string, v string, dt string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def table(spark, path):
    found = curated.read_curated(spark, path)
    return sorted((r["id"], r["v"], str(r["dt"])) for r in found.collect())


def test_merge_into_nothing_then_twice(spark):
    path = fresh_path(spark, "t")
    delta = rows(spark, ("1", "a", "2024-01-01"), ("2", "b", "2024-01-02"))
    for _ in range(2):  # merging the same rows again changes nothing
        merge_upsert(delta, path, "id")
        assert table(spark, path) == [("1", "a", "2024-01-01"), ("2", "b", "2024-01-02")]


def test_merge_touches_affected_partitions_only(spark):
    path = fresh_path(spark, "t")
    full_load(
        rows(
            spark,
            ("1", "a", "2024-01-01"),
            ("2", "b", "2024-01-01"),
            ("3", "c", "2024-01-02"),
            ("4", "d", None),
        ),
        path,
    )
    untouched = sorted(glob.glob(f"{path}/dt=2024-01-02/*"))
    merge_upsert(
        rows(spark, ("2", "B", "2024-01-01"), ("5", "e", "2024-01-03"), ("4", "D", None)), path, "id"
    )
    assert table(spark, path) == [
        ("1", "a", "2024-01-01"),
        ("2", "B", "2024-01-01"),
        ("3", "c", "2024-01-02"),
        ("4", "D", "None"),
        ("5", "e", "2024-01-03"),
    ]
    assert sorted(glob.glob(f"{path}/dt=2024-01-02/*")) == untouched


@pytest.mark.parametrize("limit", [0, 100])
def test_merge_is_the_same_with_shuffled_partition_values(spark, monkeypatch, limit):
    monkeypatch.setattr(merge, "_BROADCAST_PARTITIONS", limit)
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "1"), ("2", "b", "2"), ("3", "c", None)), path)
    merge_upsert(rows(spark, ("1", "A", "1"), ("2", "B", "2"), ("3", "C", None)), path, "id")
    assert table(spark, path) == [("1", "A", "1"), ("2", "B", "2"), ("3", "C", "None")]


def test_moved_key_leaves_a_copy_without_global_key(spark):
    for global_key, expected in (
        (False, [("1", "a", "d1"), ("1", "b", "d2"), ("2", "x", "d1"), ("3", "y", "d3")]),
        (True, [("1", "b", "d2"), ("2", "x", "d1"), ("3", "y", "d3")]),
    ):
        path = fresh_path(spark, "t")
        full_load(rows(spark, ("1", "a", "d1"), ("2", "x", "d1"), ("3", "y", "d3")), path)
        merge_upsert(rows(spark, ("1", "b", "d2")), path, "id", global_key=global_key)
        assert table(spark, path) == expected


def test_partition_emptied_by_a_move(spark):
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "d 1"), ("2", "x", None)), path)
    merge_upsert(rows(spark, ("1", "b", "d2"), ("2", "y", "d2")), path, "id", global_key=True)
    assert table(spark, path) == [("1", "b", "d2"), ("2", "y", "d2")]


def test_merge_keeps_columns_of_both_sides(spark):
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "d1"), ("2", "b", "d1")).withColumn("old", F.lit(1)), path)
    merge_upsert(rows(spark, ("2", "B", "d1")).withColumn("new", F.lit("n")), path, "id")
    found = curated.read_curated(spark, path).orderBy("id").collect()
    assert [(r["id"], r["v"], r["old"], r["new"]) for r in found] == [
        ("1", "a", 1, None),
        ("2", "B", None, "n"),
    ]


def test_merge_keeps_a_column_that_only_some_files_have(spark):
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "d1")), path)
    later = rows(spark, ("2", "b", "d2"), ("3", "c", "d2")).withColumn("extra", F.lit(7))
    curated.overwrite_partitions(later, path)
    merge_upsert(rows(spark, ("1", "A", "d1"), ("2", "B", "d2"), ("9", "z", "d9")), path, "id")
    found = spark.read.option("mergeSchema", True).parquet(path).orderBy("id").collect()
    assert [(r["id"], r["v"], r["extra"]) for r in found] == [
        ("1", "A", None),
        ("2", "B", None),
        ("3", "c", 7),
        ("9", "z", None),
    ]


def test_merge_by_two_partition_columns(spark):
    path = fresh_path(spark, "t")
    base = rows(spark, ("1", "a", "d1"), ("2", "b", "d1")).withColumn("region", F.lit("n"))
    full_load(base, path, ["dt", "region"])
    delta = rows(spark, ("1", "A", "d1")).withColumn("region", F.lit("n"))
    merge_upsert(delta, path, "id", ["dt", "region"])
    assert table(spark, path) == [("1", "A", "d1"), ("2", "b", "d1")]


def test_latest_of_the_batch_wins(spark):
    path = fresh_path(spark, "t")
    delta = rows(spark, ("1", "a", "d1"), ("1", "c", "d1"), ("1", "b", "d1"))
    merge_upsert(delta, path, "id", latest_first=[F.col("v").desc()])
    assert table(spark, path) == [("1", "c", "d1")]


def test_ties_fall_alike_in_every_run(spark):
    values = [("1", f"v{i}", "d1") for i in range(50)]
    found = set()
    for partitions in (1, 3, 8):
        path = fresh_path(spark, "t")
        merge_upsert(rows(spark, *values).repartition(partitions), path, "id")
        found.add(tuple(table(spark, path)))
    assert len(found) == 1


def test_copies_are_removed_after_success(spark):
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "d1"), ("2", "x", "d3")), path)
    merge_upsert(rows(spark, ("1", "b", "d2")), path, "id", global_key=True)
    assert glob.glob(f"{path}_*") == []
    assert table(spark, path) == [("1", "b", "d2"), ("2", "x", "d3")]


def test_an_interrupted_merge_can_be_repeated(spark, monkeypatch):
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "d1"), ("2", "x", "d1")), path)
    delta = rows(spark, ("1", "b", "d2"))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "overwrite_partitions", fail)
        with pytest.raises(OSError):
            merge_upsert(delta, path, "id", global_key=True)
    merge_upsert(delta, path, "id", global_key=True)
    assert table(spark, path) == [("1", "b", "d2"), ("2", "x", "d1")]


def test_full_load_drops_old_partitions(spark):
    path = fresh_path(spark, "t")
    full_load(rows(spark, ("1", "a", "d1")), path)
    full_load(rows(spark, ("2", "b", "d2")), path)
    assert table(spark, path) == [("2", "b", "d2")]


def test_hot_partition_is_written_as_several_files(spark, settings):
    settings(adaptive__advisoryPartitionSizeInBytes="64KB")
    path = fresh_path(spark, "t")
    hot = spark.range(200_000).select(
        F.col("id").cast("string"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    curated.overwrite_dataset(hot.withColumn("dt", F.lit("d1")), path)
    assert len(glob.glob(f"{path}/dt=d1/*.parquet")) > 1
    assert curated.read_curated(spark, path).count() == 200_000


def test_append_snapshot(spark):
    path = fresh_path(spark, "t")
    some = spark.createDataFrame([("1", "a")], "id string, v string")
    assert curated.append_snapshot(some.limit(0), path) == 0
    assert curated.read_curated(spark, path) is None
    assert curated.append_snapshot(some, path, "2024-01-01") == 1
    assert curated.append_snapshot(some, path) == 1
    assert curated.read_curated(spark, path).select("dt").distinct().count() == 2


def test_catalog_takes_up_columns_and_partitions(spark):
    path = fresh_path(spark, "t")
    name = "registered_" + path.rsplit("-", 1)[1]
    curated.overwrite_partitions(rows(spark, ("1", "a", "2024-01-01")), path)
    assert catalog.register_table(spark, name, path).count() == 1
    later = rows(spark, ("2", "b", "2024-01-02")).withColumn("extra", F.lit(1))
    curated.overwrite_partitions(later, path)
    found = catalog.register_table(spark, name, path, later.schema)
    assert sorted((r["id"], r["extra"]) for r in found.collect()) == [("1", None), ("2", 1)]


def test_catalog_asks_for_new_partitions_only(spark, monkeypatch):
    path = fresh_path(spark, "t")
    name = "registered_" + path.rsplit("-", 1)[1]
    curated.overwrite_partitions(rows(spark, ("1", "a", "it's 1"), ("2", "b", None)), path)
    assert catalog.register_table(spark, name, path).count() == 2
    curated.overwrite_partitions(rows(spark, ("3", "c", "50%"), ("4", "d", "d4")), path)
    assert catalog.add_partitions(spark, name, path, ("dt",)) == 2
    assert catalog.add_partitions(spark, name, path, ("dt",)) == 0
    found = catalog.register_table(spark, name, path)
    assert sorted((r["id"], r["dt"]) for r in found.collect()) == [
        ("1", "it's 1"), ("2", None), ("3", "50%"), ("4", "d4"),
    ]


# --- change selection, marks and state ---------------------------------------------------


def changes_frame(spark):
    return spark.createDataFrame(
        [
            ("new", utc("2024-01-10"), utc("2024-01-10")),
            ("edited", utc("2023-01-01"), utc("2024-01-05")),
            ("edge", utc("2024-01-02"), None),
            ("old", utc("2023-01-01"), utc("2023-01-02")),
            ("", utc("2024-01-10"), None),
        ],
        "id string, created timestamp, modified timestamp",
    )


def test_change_sets_are_inclusive_and_both_may_apply(spark):
    window = SyncWindow(True, utc("2024-01-02"), utc("2024-01-05"))
    found = select_changes(
        changes_frame(spark), F.col("created"), F.col("modified"), window, utc("2024-01-10")
    )
    assert sorted((r["id"], r["change_set"]) for r in found.collect()) == [
        ("", 0),
        ("edge", 0),
        ("edited", 1),
        ("new", 0),
        ("new", 1),
    ]
    latest = latest_changes(found, ["id"], [])
    assert sorted(r["id"] for r in latest.collect()) == ["edge", "edited", "new"]


def test_marks_ignore_junk_and_missing_columns(spark):
    df = spark.createDataFrame(
        [("2024-01-02",), ("junk",), ("2024-01-01T23:00:00Z",), (None,)], "created_at string"
    )
    row = high_water_marks(df).first()
    assert tuple(row) == ("2024-01-02T00:00:00.000Z", None, 4)
    assert tuple(high_water_marks(df.limit(0)).first()) == (None, None, 0)


def test_marks_are_not_later_than_now(spark):
    df = spark.createDataFrame(
        [(utc("2024-01-02"), "2030-01-01")], "created_at timestamp, last_modified_at string"
    )
    row = high_water_marks(df, utc("2024-02-01")).first()
    assert tuple(row) == ("2024-01-02T00:00:00.000Z", "2024-02-01T00:00:00.000Z", 1)
    assert later_mark(row[0], row[1]) == later_mark(row[1], row[0]) == row[1]
    assert later_mark(None, row[0]) == row[0] and later_mark(None, None) is None


def test_window_from_marks():
    both = {"last_created_at": "2024-01-02T00:00:00.000Z", "last_modified_at": "2024-01-03T01:00:00Z"}
    window = sync_window(both, True)
    assert window.created_since == utc("2024-01-01T22:00:00")
    assert window.modified_since == utc("2024-01-02T23:00:00")
    assert window.created_since.tzinfo == timezone.utc
    assert sync_window({"last_modified_at": both["last_modified_at"]}, True).created_since is None
    assert not sync_window(both, False).incremental
    assert not sync_window(None, True).incremental
    assert not sync_window({"last_created_at": None}, True).incremental


def test_changed_since(spark):
    df = changes_frame(spark)
    created, modified = F.col("created"), F.col("modified")
    window = SyncWindow(True, None, utc("2024-01-05"))
    found = changed_since(df, created, modified, window)
    assert sorted(r["id"] for r in found.collect()) == ["edited", "new"]
    assert changed_since(df, created, modified, SyncWindow(False)).count() == 5


def test_state_keeps_marks_over_an_empty_run(spark):
    path = fresh_path(spark, "state")
    assert read_sync_state(spark, path) is None
    assert get_sync_state(spark, path, "deals") is None
    put_sync_state(spark, path, "deals", "t1", "c1", "m1", 5)
    put_sync_state(spark, path, "contacts", "t1", "c9", None, 1)
    put_sync_state(spark, path, "deals", "t2")
    put_sync_state(spark, path, "contacts", "t3", None, "m9", 2)
    assert get_sync_state(spark, path, "deals") == {
        "object_type": "deals",
        "last_sync_at": "t2",
        "last_created_at": "c1",
        "last_modified_at": "m1",
        "records_processed": 0,
    }
    assert get_sync_state(spark, path, "contacts")["last_modified_at"] == "m9"
    assert read_sync_state(spark, path).count() == 2

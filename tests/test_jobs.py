import json

from dealscope.operators.state import get_sync_state
from dealscope.plans import jobs
from dealscope.plans.jobs import sync_owners, sync_stages, sync_table
from dealscope.session import fresh_path
from dealscope.sources.curated import read_curated
from dealscope.sources.raw import parse_raw_objects

from .frames import raw, utc


def deal(number, created, modified, name="d"):
    return json.dumps(
        {
            "id": str(number),
            "properties": {
                "dealname": name,
                "createdate": created,
                "hs_lastmodifieddate": modified,
            },
        }
    )


def lines(spark, kind, *objects):
    return parse_raw_objects(spark.createDataFrame([(o,) for o in objects], "value string"), kind)


def test_deals_full_then_incremental(spark):
    path, state = fresh_path(spark, "deals"), fresh_path(spark, "state")
    first = [
        deal(1, "2024-01-01T10:00:00Z", "2024-01-01T10:00:00Z"),
        deal(1, "2024-01-01T10:00:00Z", "2024-01-01T10:00:00Z"),
        deal(2, "2024-01-02T10:00:00Z", "2024-01-03T10:00:00Z"),
        deal(3, "2023-01-01T10:00:00Z", "2023-01-01T10:00:00Z"),
    ]
    count = sync_table("deals", lines(spark, "deals", *first), path, state, utc("2024-01-04"))
    assert count == 3
    stored = get_sync_state(spark, state, "deals")
    assert stored["last_modified_at"] == "2024-01-03T10:00:00.000Z"
    assert stored["records_processed"] == 3

    # Deal 1 was edited, deal 4 is new, deal 3 is edited but only before the mark.
    second = [
        deal(1, "2024-01-01T10:00:00Z", "2024-01-05T10:00:00Z", "edited"),
        deal(3, "2023-01-01T10:00:00Z", "2023-06-01T10:00:00Z", "ignored"),
        deal(4, "2024-01-05T10:00:00Z", "2024-01-05T10:00:00Z"),
        deal(5, "2030-01-01T10:00:00Z", "2030-01-05T10:00:00Z", "future"),
    ]
    raw_second = lines(spark, "deals", *second)
    for _ in range(2):  # a repeated run changes nothing
        assert sync_table("deals", raw_second, path, state, utc("2024-01-06")) == 2
        found = read_curated(spark, path).collect()
        assert sorted((r["deal_id"], r["deal_name"]) for r in found) == [
            ("1", "edited"),
            ("2", "d"),
            ("3", "d"),
            ("4", "d"),
        ]

    assert sync_table("deals", raw_second.limit(0), path, state, utc("2024-01-07")) == 0
    stored = get_sync_state(spark, state, "deals")
    assert stored["last_modified_at"] == "2024-01-05T10:00:00.000Z"
    assert read_curated(spark, path).count() == 4


def test_companies_move_between_partitions(spark):
    path, state = fresh_path(spark, "companies"), fresh_path(spark, "state")

    def company(name, modified):
        properties = {"name": name, "createdate": "2024-01-01", "hs_lastmodifieddate": modified}
        return json.dumps({"id": "c", "properties": properties})

    for name, modified in (("A", "2024-01-02"), ("B", "2024-01-09")):
        raw_rows = lines(spark, "companies", company(name, modified))
        assert sync_table("companies", raw_rows, path, state, utc("2024-01-10")) == 1
    found = read_curated(spark, path).collect()
    assert [(r["name"], str(r["dt"])) for r in found] == [("B", "2024-01-09")]


def test_activities_of_two_types_may_share_an_id(spark):
    path, state = fresh_path(spark, "activities"), fresh_path(spark, "state")

    def activity(object_type, created):
        properties = {"hs_createdate": created}
        return json.dumps({"id": "7", "object_type": object_type, "properties": properties})

    rows = lines(
        spark, "activities", activity("calls", "2024-01-01"), activity("tasks", "2024-01-02")
    )
    assert sync_table("activities", rows, path, state, utc("2024-01-10"), False) == 2
    assert read_curated(spark, path).count() == 2
    # The same objects again, incrementally: nothing is lost, and both are merged.
    assert sync_table("activities", rows, path, state, utc("2024-01-10")) >= 1
    found = read_curated(spark, path).collect()
    assert sorted((r["object_type"], r["activity_id"]) for r in found) == [
        ("calls", "7"),
        ("tasks", "7"),
    ]


def test_full_load_keeps_one_version_of_each_id(spark):
    path, state = fresh_path(spark, "deals"), fresh_path(spark, "state")
    versions = [
        deal(1, "2024-01-01T00:00:00Z", f"2024-01-{day:02d}T00:00:00Z", f"v{day}")
        for day in (3, 9, 5)
    ]
    rows = lines(spark, "deals", *versions)
    assert sync_table("deals", rows, path, state, utc("2024-02-01"), False) == 1
    assert [r["deal_name"] for r in read_curated(spark, path).collect()] == ["v9"]


def test_a_row_dated_in_the_future_does_not_stop_later_runs(spark):
    path, state = fresh_path(spark, "deals"), fresh_path(spark, "state")
    first = [
        deal(1, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z"),
        deal(2, "2024-01-01T00:00:00Z", "2030-01-01T00:00:00Z"),
    ]
    sync_table("deals", lines(spark, "deals", *first), path, state, utc("2024-01-04"))
    assert get_sync_state(spark, state, "deals")["last_modified_at"] == "2024-01-04T00:00:00.000Z"
    new = deal(3, "2024-01-05T00:00:00Z", "2024-01-05T00:00:00Z")
    rows = lines(spark, "deals", *first, new)
    # The first two were created at the mark, so they are merged again.
    assert sync_table("deals", rows, path, state, utc("2024-01-06")) == 3
    assert read_curated(spark, path).count() == 3


def test_marks_never_fall(spark):
    path, state = fresh_path(spark, "deals"), fresh_path(spark, "state")
    late = deal(1, "2024-01-03T00:00:00Z", "2024-01-03T00:00:00Z")
    sync_table("deals", lines(spark, "deals", late), path, state, utc("2024-01-04"))
    early = deal(2, "2024-01-02T23:00:00Z", "2024-01-02T23:00:00Z")
    assert sync_table("deals", lines(spark, "deals", early), path, state, utc("2024-01-05")) == 1
    assert get_sync_state(spark, state, "deals")["last_modified_at"] == "2024-01-03T00:00:00.000Z"


def test_contacts_full_load_without_incremental(spark):
    path, state = fresh_path(spark, "contacts"), fresh_path(spark, "state")
    contact = json.dumps({"id": "1", "properties": {"createdate": "1704067200000"}})
    for _ in range(2):
        rows = lines(spark, "contacts", contact)
        assert sync_table("contacts", rows, path, state, utc("2024-01-10"), False) == 1
    assert str(read_curated(spark, path).first()["dt"]) == "2024-01-01"


def test_dimensions_are_replaced(spark):
    owners, stages = fresh_path(spark, "owners"), fresh_path(spark, "stage")
    for name in ("Ana", "Eva"):
        versions = [("1", name, None, None, None, "2"), ("1", "old", None, None, None, "1")]
        sync_owners(raw(spark, "owners", *versions), owners)
    sync_owners(raw(spark, "owners", ("1", "x", None, None, None, None)).limit(0), owners)
    assert [r["owner_name"] for r in read_curated(spark, owners).collect()] == ["Eva"]
    pipeline = '{"id": "p", "stages": [{"id": "s"}]}'
    for _ in range(2):
        sync_stages(lines(spark, "pipelines", pipeline), stages)
    assert read_curated(spark, stages).count() == 1


def test_versions_are_reduced_and_cleaned_with_one_shuffle(spark, monkeypatch):
    written = []

    def watched(df, path):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, path)

    stage = jobs.stage
    monkeypatch.setattr(jobs, "stage", watched)

    def note(created, modified):
        times = {"hs_createdate": created, "hs_lastmodifieddate": modified}
        return json.dumps({"id": "1", "object_type": "notes", "properties": times})

    old, new = "2024-01-01T00:00:00Z", "2024-01-05T00:00:00Z"
    found = parse_raw_objects(
        spark.createDataFrame(
            [(t,) for t in (note(old, old), note(old, old), note("junk", new))], "value string"
        ),
        "activities",
    )
    path = fresh_path(spark, "activities")
    # The later version has no creation time, so it does not hide the earlier one.
    assert sync_table("activities", found, path, fresh_path(spark, "state"), utc("2024-02-01")) == 1
    rows = spark.read.parquet(path).collect()
    assert [str(r["last_modified_at"]) for r in rows] == ["2024-01-01 00:00:00"]
    assert written[0].count("Exchange hashpartitioning") == 1

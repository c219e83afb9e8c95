from pyspark.sql import functions as F

from dealscope.operators import normalize
from dealscope.schemas import ACTIVITIES, DEALS
from dealscope.session import fresh_path
from dealscope.sources import raw as raw_source
from dealscope.vocabulary import DEAL_PROPERTIES

from .frames import raw, utc

OWNER = DEAL_PROPERTIES["owner_id"]


def lines(spark, kind, *objects):
    df = spark.createDataFrame([(o,) for o in objects], "value string")
    return raw_source.parse_raw_objects(df, kind)


def naive(text):
    return utc(text).replace(tzinfo=None)


def test_deal_with_everything_missing(spark):
    row = normalize.normalize_deals(lines(spark, "deals", '{"id": "1"}')).first().asDict()
    assert row.pop("deal_id") == "1"
    assert row.pop("deal_name") == ""
    assert set(row.values()) == {None}


def test_deal_names_missing_null_and_given(spark):
    found = normalize.normalize_deals(
        lines(
            spark,
            "deals",
            '{"id": "1", "properties": {}}',
            '{"id": "2", "properties": {"dealname": null}}',
            '{"id": "3", "properties": {"dealname": "x"}}',
        )
    )
    assert {r["deal_id"]: r["deal_name"] for r in found.collect()} == {"1": "", "2": None, "3": "x"}


def test_deal_stage_times_prefer_the_newer_property(spark):
    found = normalize.normalize_deals(
        lines(
            spark,
            "deals",
            '{"id": "1", "properties": {"createdate": "2024-01-05T23:30:00Z", "amount": 12.5,'
            ' "hs_v2_date_entered_closedwon": "1704500000000",'
            ' "hs_date_entered_closedwon": "2020-01-01",'
            ' "hs_v2_date_entered_closedlost": "", "hs_date_entered_closedlost": "2024-01-07"},'
            ' "associations": {"companies": {"results": [{"id": "c1"}, {"id": "c2"}]},'
            ' "contacts": {"results": []}}}',
        )
    )
    assert found.columns == DEALS.names
    row = found.first()
    assert row["closed_won_at"] == naive("2024-01-06T00:13:20")
    assert row["closed_lost_at"] == naive("2024-01-07T00:00:00")
    assert (row["company_id"], row["contact_id"]) == ("c1", None)
    assert (row["dt"], row["amount"]) == ("2024-01-05", "12.5")


def test_activity_columns_are_sparse(spark):
    found = normalize.normalize_activities(
        lines(
            spark,
            "activities",
            '{"id": "1", "object_type": "tasks", "properties": {"hs_createdate": "2024-01-01"}}',
            '{"id": "2", "object_type": "communications", "properties": {'
            '"hs_communication_channel_type": "SMS", "hs_body_preview": "p",'
            f' "{OWNER}": ""}}}}',
            '{"id": "3", "object_type": "meals", "properties": {}}',
        )
    )
    assert found.columns == ACTIVITIES.names
    rows = {row["activity_id"]: row for row in found.collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"]["task_body"], rows["1"]["note_body"]) == ("", None)
    assert rows["1"]["last_modified_at"] == naive("2024-01-01T00:00:00")
    assert (rows["2"]["activity_type"], rows["2"]["communication_body"]) == ("SMS", "p")
    assert rows["2"]["communication_source"] == "CRM_v3_Communications"
    assert rows["2"]["owner_id"] is None
    assert normalize.keep_dated_distinct(found).count() == 1


def test_owner_names(spark):
    found = normalize.normalize_owners(
        raw(
            spark,
            "owners",
            ("1", "Ana", "Paz", "", None, None),
            ("2", None, "Paz", "p@x", None, None),
            ("3", " ", None, None, None, None),
        )
    ).collect()
    assert [(r["owner_name"], r["owner_email"]) for r in found] == [
        ("Ana Paz", None),
        ("Paz", "p@x"),
        ("Unknown", None),
    ]


def test_pipelines_without_stages_give_no_rows(spark):
    found = normalize.flatten_pipelines(
        lines(
            spark,
            "pipelines",
            '{"id": "p", "label": "P", "stages": null}',
            '{"id": "q", "label": "Q", "stages": [{"id": "s", "label": "S", "displayOrder": 2,'
            ' "metadata": {"isClosed": "true", "probability": "1.0"}}, {"id": "t"}]}',
        )
    ).collect()
    assert [tuple(r) for r in found] == [
        ("q", "Q", "s", "S", 2, "true", "1.0"),
        ("q", "Q", "t", None, None, None, None),
    ]


def test_association_spellings(spark):
    found = normalize.flatten_associations(
        lines(
            spark,
            "associations",
            '{"from": {"id": "1"}, "to": [{"id": "a"}, {"toObjectId": 7}, {"other": 1}]}',
            '{"from": {"objectId": 2}, "to": []}',
            '{"fromObjectId": "3", "to": [], "toObjects": ["x", 5]}',
            '{"id": "4"}',
            '{"from": {}, "to": [{"id": "lost"}]}',
        ),
        [F.col("id").desc()],
    )
    assert {r["from_id"]: r["to_ids"] for r in found.collect()} == {
        "1": ["a", "7"],
        "2": [],
        "3": ["x", "5"],
        "4": [],
    }


def test_later_association_result_wins(spark):
    results = lines(
        spark,
        "associations",
        '{"id": "4", "to": [{"id": "old"}], "fromId": "1"}',
        '{"id": "9", "to": [{"id": "new"}], "fromId": "1"}',
    )
    found = normalize.flatten_associations(results, [F.col("id").desc()]).collect()
    assert [tuple(r) for r in found] == [("1", ["new"])]


def test_alternate_activities(spark):
    found = normalize.normalize_activities_alternate(
        lines(
            spark,
            "activities",
            '{"id": "1", "object_type": "communications", "properties":'
            ' {"hs_channel": "My LinkedIn", "hs_timestamp": "", "createdate": "x",'
            ' "hs_created_by": "me"}}',
            '{"id": "2", "object_type": "communications", "properties": {}}',
            f'{{"id": "3", "object_type": "phone NOTES", "properties": {{"{OWNER}": "o"}}}}',
        )
    ).collect()
    assert [tuple(r) for r in found] == [
        ("1", "LinkedIn Message", "communications", "My LinkedIn", "me", "x"),
        ("2", "Communication", "communications", None, None, None),
        ("3", "Phone notes", "phone NOTES", None, "o", None),
    ]


def test_json_object_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    plan = normalize.normalize_deals(raw_source.parse_raw_objects(df, "deals"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_landed_folders_give_the_object_type(spark):
    path = fresh_path(spark, "landing")
    df = spark.createDataFrame(
        [
            ('{"id": "1", "properties": {"hs_createdate": "2024-01-01"}}', "calls"),
            ('{"id": "2", "properties": {"hs_createdate": "2024-01-02"}}', "notes"),
            ("not json", "notes"),
        ],
        "value string, object_type string",
    )
    df.write.partitionBy("object_type").text(path)
    found = normalize.normalize_activities(raw_source.read_raw_objects(spark, path, "activities"))
    types = {r["activity_id"]: r["activity_type"] for r in found.collect()}
    assert types == {"1": "CALL", "2": "NOTE", None: "NOTE"}
    assert normalize.keep_dated_distinct(found).count() == 2

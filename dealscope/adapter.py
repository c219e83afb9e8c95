"""CRM tables over the test data: orders as deals, events as activities, and so on.

Maps a folder with the ``orders customer supplier events nation region`` Parquet tables to
the curated tables, and to the raw objects those would have come from. Only projections
and filters are used, so the mapping adds no shuffle to a query.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.config import SalesConfig
from dealscope.schemas import ACTIVITIES
from dealscope.vocabulary import DEAL_PROPERTIES, STAGE_CODES

CONFIG = SalesConfig(
    as_of=date(2024, 1, 24),
    first_month=date(2022, 1, 1),
    owner_allow_list=("1", "2", "3", "5", "8"),
)


# Schemas of the test tables, so that no job has to look into the files first.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


_HOUR = "3600000000L"
_DAY = "86400000000L"
_DT = "date_format(created_at, 'yyyy-MM-dd') AS dt"


def deals(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as deals; every fifth deal has a second, later version."""
    # Times are added up as microseconds, which costs less than interval arithmetic.
    staged = _table(spark, folder, "orders").selectExpr(
        "o_orderkey AS k",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        f"unix_micros(CAST(o_orderdate AS timestamp)) + 8215 * {_DAY} + k % 24 * {_HOUR} AS created",
        f"IF(k % 10 = 0, NULL, created + k % 7 * {_DAY}) AS op",
        f"IF(k % 5 = 0, NULL, op + (k % 11 * 20 - 20) * {_HOUR}) AS prep",
        f"IF(k % 4 = 0, NULL, prep + k % 13 * 17 * {_HOUR}) AS sent",
        f"IF(o_orderstatus = 'F', created + (30 + k % 90) * {_DAY}, NULL) AS won",
        f"IF(o_orderstatus = 'O' AND k % 3 = 0, created + (15 + k % 60) * {_DAY}, NULL) AS lost",
        f"coalesce(won, lost, IF(k % 17 = 0, created + 20 * {_DAY}, NULL)) AS closed",
        f"coalesce(closed, created + k % 30 * {_DAY}) AS modified",
    )
    versions = staged.selectExpr("*", "explode(IF(k % 5 = 0, array(1, 2), array(1))) AS version")
    return versions.selectExpr(
        "CAST(k AS string) AS deal_id",
        "concat('Deal ', k, IF(version = 2, ' v2', '')) AS deal_name",
        "IF(k % 37 = 0, NULL, CAST(o_custkey % 120 AS string)) AS owner_id",
        "concat(IF(k % 10 = 3, 'gone-', ''), o_custkey) AS company_id",
        "IF(k % 2 = 0, CAST(o_custkey AS string), NULL) AS contact_id",
        "CASE o_orderstatus WHEN 'F' THEN 'closedwon' WHEN 'O' THEN 'closedlost' "
        "ELSE 'appointmentscheduled' END AS deal_stage",
        "timestamp_micros(created) AS created_at",
        "timestamp_micros(closed) AS closed_at",
        f"timestamp_micros(IF(version = 2, modified + {_DAY}, modified)) AS last_modified_at",
        "IF(k % 50 = 0, 'n/a', CAST(o_totalprice AS string)) AS amount",
        "timestamp_micros(op) AS op_detected_at",
        "timestamp_micros(prep) AS proposal_prep_at",
        "timestamp_micros(sent) AS proposal_sent_at",
        "timestamp_micros(won) AS closed_won_at",
        "timestamp_micros(lost) AS closed_lost_at",
        "nullif(o_orderpriority, '') AS source",
        "date_format(timestamp_micros(created), 'yyyy-MM-dd') AS dt",
    )


def owners(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "supplier").selectExpr(
        "CAST(s_suppkey AS string) AS owner_id",
        "s_name AS owner_name",
        "concat('s', s_suppkey, '@example.com') AS owner_email",
        "CAST(NULL AS string) AS created_at",
        "CAST(NULL AS string) AS last_modified_at",
    )


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "customer").selectExpr(
        "CAST(c_custkey AS string) AS contact_id",
        "CAST(c_custkey % 120 AS string) AS owner_id",
        "c_mktsegment AS firstname",
        "c_name AS lastname",
        "concat('c', c_custkey, '@example.com') AS email",
        "TIMESTAMP '2024-01-01 00:00:00' "
        "+ make_dt_interval(CAST(c_custkey % 30 AS int), CAST(c_custkey % 24 AS int)) "
        "AS created_at",
        "timestampadd(DAY, c_custkey % 9, created_at) AS last_modified_at",
        _DT,
    )


def companies(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as companies, partitioned by modification date.

    Every tenth deal names a company that does not exist.
    """
    return _table(spark, folder, "customer").selectExpr(
        "CAST(c_custkey AS string) AS company_id",
        "c_name AS name",
        "TIMESTAMP '2023-12-01 00:00:00' "
        "+ make_dt_interval(CAST(c_custkey % 28 AS int)) AS created_at",
        "IF(c_custkey % 7 = 0, NULL, TIMESTAMP '2024-01-01 00:00:00' "
        "+ make_dt_interval(CAST(c_custkey % 20 AS int), CAST(c_custkey % 24 AS int))) "
        "AS last_modified_at",
        "date_format(coalesce(last_modified_at, created_at), 'yyyy-MM-dd') AS dt",
    )


def _activity_base(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events").selectExpr(
        "event_id AS k",
        "event_type",
        "CAST(user_id % 120 AS string) AS owner_id",
        "CAST(ts AS timestamp) AS created_at",
        "timestampadd(HOUR, event_id % 5, CAST(ts AS timestamp)) AS last_modified_at",
    )


# What the events' types stand for, as SQL over the event number k.
_NOTE_BODY = (
    "CASE k % 4 WHEN 0 THEN concat('Sent via LinkedIn ', k) "
    "WHEN 1 THEN concat('whatsApp call ', k) ELSE concat('Visit ', k) END"
)
_DIRECTION = (
    "CASE k % 3 WHEN 0 THEN 'INCOMING_EMAIL' WHEN 1 THEN 'EMAIL' ELSE 'FORWARDED_EMAIL' END"
)
_CHANNEL = "CASE k % 3 WHEN 0 THEN 'WHATS_APP' WHEN 1 THEN 'LINKEDIN_MESSAGE' ELSE 'SMS' END"


def activities(spark: SparkSession, folder: str) -> DataFrame:
    """Events as curated activities, with every branch of the category rules."""
    filled = {
        "activity_id": "CAST(k AS string)",
        "activity_type": "CASE event_type WHEN 'signup' THEN 'NOTE' "
        "WHEN 'purchase' THEN IF(k % 2 = 0, 'EMAIL', 'INCOMING_EMAIL') "
        "WHEN 'view' THEN 'call' "
        f"WHEN 'click' THEN {_CHANNEL} "
        "ELSE CASE k % 6 WHEN 0 THEN 'MEETING' WHEN 1 THEN 'TASK' WHEN 2 THEN 'FORWARDED_EMAIL' "
        "WHEN 3 THEN 'Postal' WHEN 4 THEN 'Other' ELSE NULL END END",
        "owner_id": "owner_id",
        "created_at": "created_at",
        "last_modified_at": "last_modified_at",
        "communication_body": "IF(event_type = 'signup' AND k % 5 = 2, 'about WhatsApp', NULL)",
        "communication_source": "IF(event_type = 'error' AND k % 6 > 3, "
        "CASE k % 5 WHEN 0 THEN 'LinkedIn import' WHEN 1 THEN 'WHATSAPP import' END, NULL)",
        "email_direction": f"IF(event_type = 'purchase', {_DIRECTION}, NULL)",
        "note_body": f"IF(event_type = 'signup', {_NOTE_BODY}, NULL)",
        "dt": "date_format(created_at, 'yyyy-MM-dd')",
    }
    return _activity_base(spark, folder).selectExpr(
        *[f"{filled.get(name, 'CAST(NULL AS string)')} AS {name}" for name in ACTIVITIES.names]
    )


def tables(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """All curated tables of the view layer, made when they are asked for."""
    makers = [deals, activities, contacts, companies, owners]
    return {maker.__name__: partial(maker, spark, folder) for maker in makers}


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _millis(column: str) -> Column:
    return F.unix_millis(F.col(column)).cast("string")


def _some(rows: DataFrame, key: str, where: Column | None) -> DataFrame:
    """Rows whose key, as the number ``k``, meets the condition; all without one."""
    if where is None:
        return rows
    return rows.withColumn("k", F.col(key).cast("bigint")).filter(where)


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields)).alias("value")


def _associated(column: str) -> Column:
    """Association with the object first in its results, and a second one behind it."""
    both = F.array(
        F.struct(F.col(column).alias("id")),
        F.struct(F.concat(column, F.lit("-later")).alias("id")),
    )
    results = F.when(F.col(column).isNotNull(), both).otherwise(F.array().cast(
        "array<struct<id:string>>"
    ))
    return F.struct(results.alias("results"))


def raw_deals(
    spark: SparkSession, folder: str, where: Column | None = None
) -> DataFrame:
    """Deals as JSON text of CRM objects, times in ISO and epoch form, names old and new.

    Here and below ``where`` picks objects by their number, the column ``k``.
    """
    d = _some(deals(spark, folder), "deal_id", where)
    k = F.col("deal_id").cast("bigint")
    op, won = STAGE_CODES["op"], STAGE_CODES["won"]
    properties = F.struct(
        F.when(k % 11 != 0, F.col("deal_name")).alias("dealname"),
        F.col("deal_stage").alias("dealstage"),
        F.col("owner_id").alias(DEAL_PROPERTIES["owner_id"]),
        F.col("amount").alias("amount"),
        F.when(k % 2 == 0, _millis("created_at")).otherwise(_iso("created_at")).alias("createdate"),
        F.when(k % 13 == 0, F.lit("someday")).otherwise(_iso("closed_at")).alias("closedate"),
        _iso("last_modified_at").alias("hs_lastmodifieddate"),
        # The newer name is empty for every third deal, so the older one counts.
        F.when(k % 3 == 0, F.lit("")).otherwise(_millis("op_detected_at")).alias(
            f"hs_v2_date_entered_{op}"
        ),
        _iso("op_detected_at").alias(f"hs_date_entered_{op}"),
        _iso("proposal_prep_at").alias(f"hs_date_entered_{STAGE_CODES['prep']}"),
        _millis("proposal_sent_at").alias(f"hs_v2_date_entered_{STAGE_CODES['sent']}"),
        _iso("closed_won_at").alias(f"hs_v2_date_entered_{won}"),
        _iso("closed_lost_at").alias(f"hs_date_entered_{STAGE_CODES['lost']}"),
        F.when(k % 6 == 0, F.lit("")).when(k % 6 == 1, F.lit("Campaign")).alias("deal_source"),
        F.when(k % 6 < 2, F.lit("")).alias("source"),
        F.when(k % 6 == 2, F.lit("Fair")).alias("lead_source"),
        F.col("source").alias("hs_analytics_source_data_1"),
    )
    associations = F.struct(
        _associated("company_id").alias("companies"), _associated("contact_id").alias("contacts")
    )
    return d.select(
        _json(
            F.col("deal_id").alias("id"),
            properties.alias("properties"),
            associations.alias("associations"),
        )
    )


def raw_activities(
    spark: SparkSession, folder: str, where: Column | None = None
) -> DataFrame:
    """Events as JSON text of the six activity object types, with ``object_type``."""
    base = _some(_activity_base(spark, folder), "k", where).withColumn(
        "object_type",
        F.expr(
            "CASE event_type WHEN 'signup' THEN 'notes' WHEN 'purchase' THEN 'emails' "
            "WHEN 'view' THEN 'calls' WHEN 'click' THEN 'communications' "
            "ELSE IF(k % 2 = 0, 'meetings', 'tasks') END"
        ),
    )

    def of(object_type: str, sql: str) -> Column:
        return F.when(F.col("object_type") == object_type, F.expr(sql))

    k = F.col("k")
    properties = F.struct(
        F.when(k % 97 == 0, F.lit("junk")).otherwise(_iso("created_at")).alias("hs_createdate"),
        F.when(k % 4 == 0, F.lit("")).otherwise(_iso("last_modified_at")).alias(
            "hs_lastmodifieddate"
        ),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.col("owner_id")).alias(DEAL_PROPERTIES["owner_id"]),
        F.lit("creator").alias("hs_created_by"),
        F.when(k % 8 == 0, _iso("created_at")).alias("hs_timestamp"),
        of("communications", f"IF(k % 5 = 0, 'CARRIER_PIGEON', {_CHANNEL})").alias(
            "hs_communication_channel_type"
        ),
        of("communications", "IF(k % 5 = 0, '', lower(concat('via ', "
           f"{_CHANNEL.replace('WHATS_APP', 'WhatsApp')})))").alias("hs_communications_channel"),
        of("communications", "IF(k % 2 = 0, concat('body ', k), '')").alias(
            "hs_communication_body"
        ),
        of("communications", "concat('preview ', k)").alias("hs_body_preview"),
        of("tasks", "concat('Task ', k)").alias("hs_task_subject"),
        of("tasks", "IF(k % 3 = 0, 'WAITING', NULL)").alias("hs_task_status"),
        of("calls", "concat('Call ', k)").alias("hs_call_title"),
        of("calls", "CAST(k % 600 AS string)").alias("hs_call_duration"),
        of("meetings", "concat('Meeting ', k)").alias("hs_meeting_title"),
        of("meetings", "IF(k % 4 = 0, 'COMPLETED', NULL)").alias("hs_meeting_outcome"),
        of("emails", "concat('Mail ', k)").alias("hs_email_subject"),
        of("emails", f"IF(k % 10 = 0, NULL, {_DIRECTION})").alias("hs_email_direction"),
        of("notes", _NOTE_BODY).alias("hs_note_body"),
    )
    return base.select(
        _json(
            k.cast("string").alias("id"),
            F.col("object_type").alias("object_type"),
            properties.alias("properties"),
        ),
        "object_type",
    )


def raw_contacts(
    spark: SparkSession, folder: str, where: Column | None = None
) -> DataFrame:
    c = _some(contacts(spark, folder), "contact_id", where)
    properties = F.struct(
        F.col("owner_id").alias(DEAL_PROPERTIES["owner_id"]),
        "firstname",
        "lastname",
        "email",
        _iso("created_at").alias("createdate"),
        _millis("last_modified_at").alias("lastmodifieddate"),
    )
    return c.select(_json(F.col("contact_id").alias("id"), properties.alias("properties")))


def raw_companies(
    spark: SparkSession, folder: str, where: Column | None = None
) -> DataFrame:
    c = _some(companies(spark, folder), "company_id", where)
    properties = F.struct(
        "name",
        _iso("created_at").alias("createdate"),
        _iso("last_modified_at").alias("hs_lastmodifieddate"),
        F.lit("example.com").alias("domain"),
    )
    return c.select(_json(F.col("company_id").alias("id"), properties.alias("properties")))


def raw_owners(spark: SparkSession, folder: str) -> DataFrame:
    s = _table(spark, folder, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        _json(
            k.cast("string").alias("id"),
            F.when(k % 4 != 0, F.lit("Ana")).alias("firstName"),
            F.when(k % 3 != 0, F.col("s_name")).otherwise("").alias("lastName"),
            F.when(k % 5 == 0, F.lit("")).otherwise(
                F.concat(F.lit("s"), k.cast("string"), F.lit("@example.com"))
            ).alias("email"),
            F.lit("2024-01-01T00:00:00.000Z").alias("createdAt"),
            F.lit("2024-01-02T00:00:00.000Z").alias("updatedAt"),
        )
    )


def raw_pipelines(spark: SparkSession, folder: str) -> DataFrame:
    """Each nation as a pair of stages of its region's pipeline; every sixth has none."""
    n = _table(spark, folder, "nation")
    r = _table(spark, folder, "region")
    k = F.col("n_nationkey")

    def stage(number: Column, closed: str) -> Column:
        return F.struct(
            number.cast("string").alias("id"),
            F.col("n_name").alias("label"),
            number.alias("displayOrder"),
            F.struct(
                F.lit(closed).alias("isClosed"), (number % 10 / 10).cast("string").alias("probability")
            ).alias("metadata"),
        )

    stages = F.array(stage(k, "false"), stage(k + 100, "true"))
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        _json(
            F.col("r_regionkey").cast("string").alias("id"),
            F.col("r_name").alias("label"),
            F.when(k % 6 != 5, stages).alias("stages"),
        )
    )


def raw_associations(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as association results in the different spellings, as JSON text."""
    o = _table(spark, folder, "orders")
    k = F.col("o_orderkey")
    text = k.cast("string")
    to_objects = F.array(
        F.struct(F.col("o_custkey").cast("string").alias("toObjectId")),
        F.struct((F.col("o_custkey") + 1).cast("string").alias("toObjectId")),
    )
    to_ids = F.array(F.struct(F.col("o_custkey").cast("string").alias("id")))
    return o.select(
        _json(
            F.when(k % 3 == 0, F.struct(text.alias("id"))).alias("from"),
            F.when(k % 3 == 1, text).alias("fromId"),
            F.when((k % 3 == 2) & (k % 11 != 0), text).alias("fromObjectId"),
            F.when(k % 2 == 0, to_ids).alias("to"),
            F.when(k % 2 == 1, to_objects).alias("toObjects"),
        )
    )

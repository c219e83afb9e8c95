"""Normalizers: raw CRM objects to rows of the curated tables.

Each is one projection of the raw table, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope import vocabulary as V
from dealscope.functions.parsing import (
    blank_to_null,
    contains_any,
    first_filled,
    iso_to_utc,
    number,
    parse_mixed_timestamp,
    partition_date,
)
from dealscope.operators.dedupe import any_order, latest_per_key
from dealscope.schemas import ACTIVITIES, COMPANIES, CONTACTS, DEALS, OWNERS, STAGE


def prop(name: str) -> Column:
    """Property of a raw object; null when it is missing."""
    return F.col("properties")[name]


def first_filled_prop(names: Sequence[str]) -> Column:
    """First of the properties that is neither missing, null nor empty."""
    return first_filled(*[prop(name) for name in names])


def stage_entry_text(code: str) -> Column:
    """Raw time a deal entered a stage; the newer property name goes first."""
    return first_filled_prop([prefix + code for prefix in V.STAGE_ENTRY_PREFIXES])


def stage_entered_at(code: str) -> Column:
    """When a deal entered a stage."""
    return parse_mixed_timestamp(stage_entry_text(code))


def first_associated_id(association: str) -> Column:
    """Id of the first object associated under a name."""
    return F.get(F.col("associations")[association]["results"], F.lit(0))["id"]


def specific_activity_type(value: Column, default: Column) -> Column:
    """The value if it is a known activity type, else the default."""
    return F.when(value.isin(V.SPECIFIC_ACTIVITY_TYPES), value).otherwise(default)


def by_object_type(column_of: dict[str, Column]) -> Column:
    """Column chosen by the row's object type; null for other types."""
    chosen = F.lit(None).cast("string")
    for object_type, column in column_of.items():
        chosen = F.when(F.col("object_type") == object_type, column).otherwise(chosen)
    return chosen


def activity_type() -> Column:
    """Activity type of a raw activity, by its object type and direction or channel."""
    default = by_object_type({k: F.lit(v) for k, v in V.DEFAULT_ACTIVITY_TYPE.items()})
    specific = by_object_type({k: prop(name) for k, name in V.SPECIFIC_TYPE_PROPERTY.items()})
    return specific_activity_type(specific, default)


def activity_metadata() -> list[Column]:
    """Sparse metadata columns: filled for their own object type only, there never null."""
    columns = []
    for name, (object_type, sources) in V.ACTIVITY_METADATA.items():
        if name == "communication_source":
            value = F.lit(V.COMMUNICATION_SOURCE)
        else:
            value = F.coalesce(first_filled_prop(sources), F.lit(""))
        columns.append(by_object_type({object_type: value}).alias(name))
    return columns


def _parsed(texts: DataFrame, columns: Sequence[str], partition_by: str) -> DataFrame:
    """Parse the named text columns in place, and add the partition date of one.

    The texts are picked from the properties in a projection of their own, so that parsing,
    which looks at a text several times, does not pick it each time.
    """
    parsed = texts.withColumns({name: parse_mixed_timestamp(F.col(name)) for name in columns})
    return parsed.withColumn("dt", partition_date(F.col(partition_by)))


def _picked(properties: dict[str, str]) -> list[Column]:
    return [prop(name).alias(column) for column, name in properties.items()]


def normalize_deals(raw: DataFrame) -> DataFrame:
    properties = dict(V.DEAL_PROPERTIES)
    # A missing name is empty, one given as null stays null.
    name = properties.pop("deal_name")
    has_name = F.coalesce(F.map_contains_key("properties", F.lit(name)), F.lit(False))
    stages = {column: V.STAGE_CODES[stage] for column, stage in V.STAGE_TIMES.items()}
    texts = raw.select(
        F.col("id").alias("deal_id"),
        F.when(has_name, prop(name)).otherwise("").alias("deal_name"),
        first_associated_id(V.ASSOCIATED_COMPANIES).alias("company_id"),
        first_associated_id(V.ASSOCIATED_CONTACTS).alias("contact_id"),
        *_picked(properties),
        *[stage_entry_text(code).alias(column) for column, code in stages.items()],
        first_filled_prop(V.DEAL_SOURCE_PROPERTIES).alias("source"),
    )
    times = [f.name for f in DEALS.fields if f.dataType.typeName() == "timestamp"]
    return _parsed(texts, times, "created_at").select(*DEALS.names)


def normalize_activities(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All six object types in one pass; ``object_type`` tells them apart.

    ``keep`` names raw columns that stay beside the curated ones.
    """
    names = V.ACTIVITY_PROPERTIES
    modified = first_filled_prop([names["last_modified_at"], names["created_at"]])
    texts = raw.filter(F.col("object_type").isin(list(V.DEFAULT_ACTIVITY_TYPE))).select(
        F.col("id").alias("activity_id"),
        activity_type().alias("activity_type"),
        blank_to_null(prop(names["owner_id"])).alias("owner_id"),
        prop(names["created_at"]).alias("created_at"),
        modified.alias("last_modified_at"),
        *activity_metadata(),
        *keep,
    )
    return _parsed(texts, ["created_at", "last_modified_at"], "created_at").select(
        *ACTIVITIES.names, *keep
    )


def keep_dated_distinct(rows: DataFrame) -> DataFrame:
    """Drop rows without creation time, then rows equal in every column."""
    return rows.filter(F.col("created_at").isNotNull()).dropDuplicates()


def normalize_contacts(raw: DataFrame) -> DataFrame:
    texts = raw.select(F.col("id").alias("contact_id"), *_picked(V.CONTACT_PROPERTIES))
    return _parsed(texts, ["created_at", "last_modified_at"], "created_at").select(
        *CONTACTS.names
    )


def normalize_companies(raw: DataFrame) -> DataFrame:
    """Companies; their times come in ISO form only, and the partition is that of the change."""
    texts = raw.select(F.col("id").alias("company_id"), *_picked(V.COMPANY_PROPERTIES))
    times = ["created_at", "last_modified_at"]
    parsed = texts.withColumns({name: iso_to_utc(F.col(name)) for name in times})
    dt = partition_date(F.coalesce("last_modified_at", "created_at"))
    return parsed.withColumn("dt", dt).select(*COMPANIES.names)


def normalize_owners(raw: DataFrame) -> DataFrame:
    full_name = F.trim(F.concat_ws(" ", "firstName", "lastName"))
    return raw.select(
        F.col("id").alias("owner_id"),
        first_filled(full_name, F.lit(V.UNNAMED_OWNER)).alias("owner_name"),
        blank_to_null(F.col("email")).alias("owner_email"),
        F.col("createdAt").alias("created_at"),
        F.col("updatedAt").alias("last_modified_at"),
    ).select(*OWNERS.names)


def flatten_pipelines(raw: DataFrame) -> DataFrame:
    """One row per pipeline stage; a pipeline without stages gives none."""
    return raw.select(
        F.col("id").alias("pipeline_id"),
        F.col("label").alias("pipeline_label"),
        F.explode("stages").alias("stage"),
    ).select(
        "pipeline_id",
        "pipeline_label",
        F.col("stage.id").alias("stage_id"),
        F.col("stage.label").alias("stage_label"),
        F.col("stage.displayOrder").alias("display_order"),
        F.col("stage.metadata.isClosed").alias("is_closed"),
        F.col("stage.metadata.probability").alias("probability"),
    ).select(*STAGE.names)


def normalize_activities_alternate(raw: DataFrame) -> DataFrame:
    """Slim activity table: display name of the type, raw time, owner and channel."""
    object_type = F.col("object_type")
    communication = contains_any(
        F.col("channel"), V.ALTERNATE_CHANNEL_NAMES, F.lit(V.ALTERNATE_CHANNEL_DEFAULT)
    )
    capitalized = F.concat(
        F.upper(F.substring(object_type, 1, 1)),
        F.lower(F.expr("substring(object_type, 2)")),
    )
    names = {k: F.lit(v) for k, v in V.ALTERNATE_ACTIVITY_NAMES.items()}

    def first_or_last(properties: Sequence[str]) -> Column:
        """First filled property; the last one is passed on even when empty."""
        return F.coalesce(first_filled_prop(properties[:-1]), prop(properties[-1]))

    picked = raw.select(
        F.col("id").alias("activity_id"),
        "object_type",
        *[
            first_or_last(properties).alias(column)
            for column, properties in V.ALTERNATE_ACTIVITY_PROPERTIES.items()
        ],
    )
    names["communications"] = communication
    return picked.select(
        "activity_id",
        F.coalesce(by_object_type(names), capitalized).alias("activity_type"),
        "object_type",
        "channel",
        "owner_id",
        "occurred_at",
    )


def normalize_deals_compact(raw: DataFrame) -> DataFrame:
    """Slim deal table with a numeric amount."""
    names = V.DEAL_PROPERTIES
    return raw.select(
        F.col("id").alias("deal_id"),
        prop(names["deal_name"]).alias("deal_name"),
        prop(names["owner_id"]).alias("owner_id"),
        number(prop(names["amount"])).alias("amount"),
        iso_to_utc(prop(names["created_at"])).alias("created_at"),
        prop(names["deal_stage"]).alias("dealstage"),
    )


def flatten_associations(raw: DataFrame, latest_first: Sequence[Column]) -> DataFrame:
    """``from_id`` with the array ``to_ids``, whatever spelling the result came in.

    A source has one row: of several results for it, the first by ``latest_first``.
    """

    def part(text: Column, names: Sequence[str]) -> Column:
        return first_filled(*[F.get_json_object(text, f"$.{name}") for name in names])

    def target(text: Column) -> Column:
        is_object = text.startswith("{")
        return F.when(is_object, part(text, V.ASSOCIATION_TO_OBJECT)).otherwise(text)

    source = F.coalesce(
        part(F.col("from"), V.ASSOCIATION_FROM_OBJECT),
        first_filled(*[F.col(name) for name in V.ASSOCIATION_FROM]),
    )
    filled_to = F.when(F.size("to") > 0, F.col("to"))
    targets = F.coalesce(filled_to, F.col("toObjects"), F.array().cast("array<string>"))
    flat = raw.withColumn("from_id", source).filter(F.col("from_id").isNotNull())
    flat = latest_per_key(flat, ["from_id"], [*latest_first, any_order(raw.columns)])
    return flat.select(
        "from_id",
        F.filter(F.transform(targets, target), lambda t: t.isNotNull()).alias("to_ids"),
    )


def explode_associations(pairs: DataFrame) -> DataFrame:
    """One row per source and target, with the target's position."""
    return pairs.select("from_id", F.posexplode("to_ids").alias("position", "to_id"))

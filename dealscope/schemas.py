"""Explicit schemas of the raw and curated tables; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from dealscope.vocabulary import ACTIVITY_METADATA


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _TIME, _INT, _LONG = StringType(), TimestampType(), IntegerType(), LongType()

# Raw CRM object: one envelope for deals, activities, contacts and companies.
RAW_OBJECT = _struct(
    id=_TEXT,
    properties=MapType(_TEXT, _TEXT),
    associations=MapType(_TEXT, _struct(results=ArrayType(_struct(id=_TEXT)))),
)

RAW_OWNER = _struct(
    id=_TEXT, firstName=_TEXT, lastName=_TEXT, email=_TEXT, createdAt=_TEXT, updatedAt=_TEXT
)

RAW_PIPELINE = _struct(
    id=_TEXT,
    label=_TEXT,
    stages=ArrayType(
        _struct(
            id=_TEXT,
            label=_TEXT,
            displayOrder=_INT,
            metadata=_struct(isClosed=_TEXT, probability=_TEXT),
        )
    ),
)

# Association results come in several spellings, and their ends as objects or bare ids.
# A JSON object read as STRING keeps its text, so both forms survive.
RAW_ASSOCIATION = StructType(
    [StructField(name, _TEXT, True) for name in ("from", "fromId", "fromObjectId", "id")]
    + [StructField(name, ArrayType(_TEXT), True) for name in ("to", "toObjects")]
)

RAW_SCHEMAS = {
    "deals": RAW_OBJECT,
    "activities": StructType(RAW_OBJECT.fields + [StructField("object_type", _TEXT, True)]),
    "contacts": RAW_OBJECT,
    "companies": RAW_OBJECT,
    "owners": RAW_OWNER,
    "pipelines": RAW_PIPELINE,
    "associations": RAW_ASSOCIATION,
}

DEALS = _struct(
    deal_id=_TEXT,
    deal_name=_TEXT,
    owner_id=_TEXT,
    company_id=_TEXT,
    contact_id=_TEXT,
    deal_stage=_TEXT,
    created_at=_TIME,
    closed_at=_TIME,
    last_modified_at=_TIME,
    amount=_TEXT,
    op_detected_at=_TIME,
    proposal_prep_at=_TIME,
    proposal_sent_at=_TIME,
    closed_won_at=_TIME,
    closed_lost_at=_TIME,
    source=_TEXT,
    dt=_TEXT,
)

ACTIVITIES = _struct(
    activity_id=_TEXT,
    activity_type=_TEXT,
    owner_id=_TEXT,
    created_at=_TIME,
    last_modified_at=_TIME,
    **{name: _TEXT for name in ACTIVITY_METADATA},
    dt=_TEXT,
)

CONTACTS = _struct(
    contact_id=_TEXT,
    owner_id=_TEXT,
    firstname=_TEXT,
    lastname=_TEXT,
    email=_TEXT,
    created_at=_TIME,
    last_modified_at=_TIME,
    dt=_TEXT,
)

COMPANIES = _struct(
    company_id=_TEXT, name=_TEXT, created_at=_TIME, last_modified_at=_TIME, dt=_TEXT
)

OWNERS = _struct(
    owner_id=_TEXT, owner_name=_TEXT, owner_email=_TEXT, created_at=_TEXT, last_modified_at=_TEXT
)

STAGE = _struct(
    pipeline_id=_TEXT,
    pipeline_label=_TEXT,
    stage_id=_TEXT,
    stage_label=_TEXT,
    display_order=_INT,
    is_closed=_TEXT,
    probability=_TEXT,
)

SYNC_STATE = _struct(
    last_sync_at=_TEXT,
    last_created_at=_TEXT,
    last_modified_at=_TEXT,
    records_processed=_LONG,
    object_type=_TEXT,
)

# How far the landing folders of each object type have been read.
LANDING_STATE = _struct(last_landed=_TEXT, object_type=_TEXT)

CURATED_SCHEMAS = {
    "deals": DEALS,
    "activities": ACTIVITIES,
    "contacts": CONTACTS,
    "companies": COMPANIES,
    "owners": OWNERS,
    "stage": STAGE,
    "sync_state": SYNC_STATE,
}

"""Small hand-made frames."""

from datetime import datetime, timezone

from dealscope.schemas import DEALS, RAW_OBJECT, RAW_SCHEMAS


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def deals(spark, *rows):
    """Deals from dictionaries; times as ISO text, other columns null unless given."""
    times = {f.name for f in DEALS.fields if f.dataType.typeName() == "timestamp"}

    def value(row, name):
        given = row.get(name)
        return utc(given) if given is not None and name in times else given

    data = []
    for row in rows:
        full = {"deal_name": row["deal_id"], "dt": row.get("created_at", "")[:10] or None, **row}
        data.append(tuple(value(full, name) for name in DEALS.names))
    return spark.createDataFrame(data, DEALS)


def raw(spark, kind, *objects):
    schema = RAW_SCHEMAS.get(kind, RAW_OBJECT)
    return spark.createDataFrame(list(objects), schema)


def owners(spark, *pairs):
    return spark.createDataFrame(list(pairs), "owner_id string, owner_name string")

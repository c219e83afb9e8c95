"""Raw CRM objects: JSON lines in a landing folder, or a column of JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dealscope.schemas import RAW_SCHEMAS


def read_raw_objects(
    spark: SparkSession,
    path: str,
    kind: str,
    landed_since: str | None = None,
    keep_landed: bool = False,
) -> DataFrame:
    """Scan landed JSON lines of one kind: deals, activities, contacts, companies, owners,
    pipelines or associations. Activities land in ``object_type=<type>/`` subfolders.

    With ``landed_since``, a date as text, the objects lie in ``landed=<date>/`` folders, and
    only those of that date and later are scanned; ``keep_landed`` keeps the date as a column.
    """
    if landed_since is None:
        return spark.read.schema(RAW_SCHEMAS[kind]).json(path)
    schema = StructType([*RAW_SCHEMAS[kind].fields, StructField("landed", StringType())])
    landed = spark.read.schema(schema).json(path)
    recent = landed.filter(F.col("landed") >= landed_since)
    return recent if keep_landed else recent.drop("landed")


def parse_raw_objects(
    lines: DataFrame, kind: str, column: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Same as :func:`read_raw_objects` for a column that holds one JSON object per row.

    ``keep`` names columns of the lines that stay, before those of the objects.
    """
    # Opening a one-element array keeps the parsed object from being substituted into each
    # expression that uses a part of it, and so from being parsed once for each.
    return lines.select(*keep, F.inline(F.array(F.from_json(column, RAW_SCHEMAS[kind]))))

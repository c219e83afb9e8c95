"""Dashboard categories of activities, and the quality class of a deal's close."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealscope import vocabulary as V
from dealscope.functions.parsing import contains_any


def activity_category(
    activity_type: Column,
    email_direction: Column,
    note_body: Column,
    communication_body: Column,
    communication_source: Column,
) -> Column:
    """Dashboard category of an activity; never null."""
    kind = F.upper(activity_type)
    email = F.when(F.upper(email_direction) == "INCOMING_EMAIL", V.CATEGORY_EMAIL_IN).otherwise(
        V.CATEGORY_EMAIL_OUT
    )
    # Either body may name the channel. A line break between them keeps a match from
    # spanning both texts.
    bodies = F.concat_ws("\n", note_body, communication_body)
    note = contains_any(bodies, V.CATEGORY_BY_TEXT, F.lit(V.CATEGORY_NOTE))
    other = contains_any(
        communication_source,
        V.CATEGORY_BY_TEXT,
        F.coalesce(activity_type, F.lit(V.CATEGORY_UNKNOWN)),
    )
    types_by_label: dict[str, list[str]] = {}
    for name, label in V.CATEGORY_BY_TYPE.items():
        types_by_label.setdefault(label, []).append(name)

    category = F.when(kind == "EMAIL", email).when(kind == "NOTE", note)
    for label, names in types_by_label.items():
        category = category.when(kind.isin(names), F.lit(label))
    return category.otherwise(other)


def deal_status_quality(closed: Column, won: Column, lost: Column) -> Column:
    """How the close of a deal is documented; the first rule that holds decides."""
    return (
        F.when(
            closed.isNotNull() & won.isNull() & lost.isNull(), F.lit(V.QUALITY_NO_TRANSITION)
        )
        .when(won.isNotNull(), F.lit(V.QUALITY_WON))
        .when(lost.isNotNull(), F.lit(V.QUALITY_LOST))
        .when(closed.isNotNull(), F.lit(V.QUALITY_UNKNOWN))
        .otherwise(F.lit(V.QUALITY_OPEN))
    )

"""Text and timestamp parsing of raw CRM properties."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last epoch millisecond a nanosecond clock can hold; larger numbers are junk.
_MAX_EPOCH_MILLIS = 9223372036854


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(value) for value in values])


def iso_to_utc(text: Column) -> Column:
    """ISO-8601 timestamp or plain date to a UTC timestamp; anything else is null."""
    # The dash after the year keeps out bare times, which Spark would complete with today's
    # date, and bare years.
    dated = F.substring(F.trim(text), 5, 1) == "-"
    return F.when(dated, F.try_to_timestamp(text))


def parse_mixed_timestamp(text: Column) -> Column:
    """Epoch milliseconds or ISO-8601 to a UTC timestamp; junk and blanks are null."""
    # The pattern goes first: a failing try_cast costs an exception per row.
    millis = text.try_cast("bigint")
    return F.when(
        text.rlike("^[0-9]+$"),
        F.when(millis <= _MAX_EPOCH_MILLIS, F.timestamp_millis(millis)),
    ).otherwise(iso_to_utc(text))


def iso_text(ts: Column) -> Column:
    """UTC timestamp to ISO-8601 text with milliseconds and ``Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def epoch_millis(text: Column, default: Column) -> Column:
    """ISO-8601 timestamp or plain date to epoch milliseconds; junk gives ``default``."""
    return F.unix_millis(F.coalesce(iso_to_utc(text), default))


def number(text: Column) -> Column:
    """Text to double; blanks and junk are null."""
    # Blanks are taken out first, as they are common and a failing try_cast is slow.
    return blank_to_null(text).try_cast("double")


def partition_date(ts: Column) -> Column:
    """Partition key ``yyyy-MM-dd`` of a UTC timestamp."""
    return F.date_format(ts, "yyyy-MM-dd")


def contains_any(text: Column, needle_to_label: dict[str, str], default: Column) -> Column:
    """Label of the first needle found in the lower-cased text."""
    lowered = F.lower(text)
    items = list(needle_to_label.items())
    return reduce(
        lambda rest, item: F.when(lowered.contains(item[0]), F.lit(item[1])).otherwise(rest),
        reversed(items),
        default,
    )

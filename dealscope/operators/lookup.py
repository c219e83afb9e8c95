"""Dimension lookups that hold up when a few keys have most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys up to which a set of them is broadcast: some megabytes.
BROADCAST_KEYS = 200_000


def lookup(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join of facts to a dimension with one row per key.

    There is no broadcast hint: Spark broadcasts the dimension when its measured size is
    below the threshold, and sort-merges otherwise. For the second case the join key gets a
    companion computed from it. Both sides are then shuffled right before the join even if
    they were partitioned by the key already, and only such joins are split by adaptive
    execution when a key (or null) is hot.
    """
    companion = F.crc32(F.col(key).cast("binary")) % 2
    right = dimension.withColumn("_side", companion)
    left = facts.withColumn("_side", companion)
    return left.join(right, [key, "_side"], "left").drop("_side")


def few_broadcast(keys: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """``keys`` with a broadcast hint if a count, which stops beyond ``most``, proves them few."""
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys


def with_owner_name(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Add ``owner_name``: the owner's name, else the id."""
    names = owners.select("owner_id", F.col("owner_name").alias("_name"))
    return (
        lookup(rows, names, "owner_id")
        .withColumn("owner_name", F.coalesce("_name", "owner_id"))
        .drop("_name")
    )

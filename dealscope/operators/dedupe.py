"""Deduplication: latest row per key, and the general merge of several inputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How a column of several rows becomes one value. Each is what folding the rows in order
# gives, and each may be computed in parts: aggregates get the value and the row's place.
COMBINE: dict[str, Callable[[Column, Column], Column]] = {
    "first": lambda value, place: F.min_by(value, place),
    "last": lambda value, place: F.max_by(value, place),
    "first_filled": lambda value, place: F.min_by(value, F.when(_filled(value), place)),
    "last_filled": lambda value, place: F.max_by(value, F.when(_filled(value), place)),
    "min": lambda value, place: F.min(value),
    "max": lambda value, place: F.max(value),
    "sum": lambda value, place: F.sum(value),
    "count": lambda value, place: F.count(value),
}


def _filled(value: Column) -> Column:
    return value.isNotNull() & (value.cast("string") != "")


def latest_per_key(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]
) -> DataFrame:
    """First row of each key in the given order.

    Spark reduces each input partition to one row per key before the shuffle
    (``WindowGroupLimit``), so a hot key does not gather in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def merge_dedupe(
    inputs: Sequence[DataFrame],
    key: str | Column = "id",
    position: Sequence[Column] = (),
    timestamp: Column | None = None,
    resolver: Mapping[str, str] | Column | None = None,
) -> DataFrame:
    """Union the inputs and keep one row per key; rows without a key are dropped.

    ``position`` orders the rows of one input; rows of a later input come after those of
    an earlier one. By default the last row wins. With ``timestamp`` the greatest one wins;
    on ties, and against a null, the earlier row stays.

    ``resolver`` is a column or a mapping. A column scores the rows: the greatest score
    wins, the earlier row on ties. A mapping makes a new row: it names a way of ``COMBINE``
    for columns, the others take their last value. Both give what folding the rows of the
    key one after the other gives, however many there are: they are aggregated with
    map-side combine, so no task holds the rows of a hot key. Functions of two rows are
    rejected, since nothing shows that those may be computed in parts.
    """
    if callable(resolver) and not isinstance(resolver, (Column, Mapping)):
        raise TypeError("a resolver is a score column or a mapping of columns to COMBINE names")
    tagged = [df.withColumn("_input", F.lit(i)) for i, df in enumerate(inputs)]
    rows = tagged[0]
    for df in tagged[1:]:
        rows = rows.unionByName(df, allowMissingColumns=True)
    columns = [name for name in rows.columns if name != "_input"]
    key_column = F.col(key) if isinstance(key, str) else key
    rows = rows.withColumn("_key", key_column).filter(F.col("_key").isNotNull())

    if isinstance(resolver, Mapping):
        return _combined(rows, columns, position, resolver)
    score = timestamp if resolver is None else resolver
    if score is not None:
        order = [F.desc_nulls_last(score), F.col("_input").asc(), *[c.asc() for c in position]]
    else:
        order = [F.col("_input").desc(), *[c.desc() for c in position]]
    return latest_per_key(rows, ["_key"], [*order, any_order(columns)]).select(*columns)


def any_order(columns: Sequence[str]) -> Column:
    """Order of rows that are equal in all that matters, the same in every run."""
    return F.xxhash64(*[F.col(f"`{name}`").cast("string") for name in columns]).desc()


def _combined(
    rows: DataFrame, columns: Sequence[str], position: Sequence[Column], ways: Mapping[str, str]
) -> DataFrame:
    """One aggregation per key over all rows."""
    unknown = set(ways) - set(columns) | {w for w in ways.values() if w not in COMBINE}
    if unknown:
        raise ValueError(f"no such column or way to combine: {sorted(unknown)}")
    hashed = F.xxhash64(*[F.col(f"`{name}`").cast("string") for name in columns])
    place = F.struct(
        F.col("_input"), *[c.alias(f"_p{i}") for i, c in enumerate(position)], hashed.alias("_h")
    )
    placed = rows.withColumn("_place", place)
    values = [
        COMBINE[ways.get(name, "last")](F.col(f"`{name}`"), F.col("_place")).alias(name)
        for name in columns
    ]
    return placed.groupBy("_key").agg(*values).select(*[f"`{name}`" for name in columns])

"""Exact grouped quantiles that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dealscope.session import fresh_path

# Distinct values of an interval up to which they are ranked in one task.
MOST_RANKED = 100_000
# Split points that a sketch proposes within an interval, and its accuracy.
_SPLITS, _ACCURACY = 127, 2000


def exact_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    most_ranked: int = MOST_RANKED,
) -> DataFrame:
    """Linearly interpolated quantiles per group: the group columns, ``n`` and ``quantiles``.

    ``percentile`` keeps every distinct value of a group in one task. Here the rows are
    reduced to distinct values with their counts and written once. A wanted rank starts with
    the interval of all values of its group. While that holds more than ``most_ranked``
    distinct ones, a sketch proposes split points in it, the values are counted between
    them, and the part that holds the rank is the next interval; whatever the sketch said,
    the counts are exact. Only values of intervals within the bound are ranked. The number
    of rounds grows with the logarithm of the largest group, and jobs run right away.
    """
    keys = list(group_cols)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    if not keys:
        rows, keys = rows.withColumn("_all", F.lit(0)), ["_all"]
    values = _written(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_count")))
    targets = _written(_first_targets(values, keys, probabilities))
    while (targets.agg(F.max("_size")).first()[0] or 0) > most_ranked:
        targets = _written(_narrowed(values, targets, keys, most_ranked))

    interval = Window.partitionBy(*keys, "_low").orderBy("_v")
    ranked = _inside(values, targets, keys).withColumn(
        "_before", F.col("_start") + _count_before(interval)
    )
    wanted = targets.drop("_start").withColumnsRenamed({k: f"r_{k}" for k in [*keys, "_low"]})
    found = ranked.join(wanted, _same([*keys, "_low"])).filter(_holds_rank())
    per_group = found.groupBy(*keys, "n").agg(
        F.collect_list(F.struct("_i", "_share", "_v")).alias("_found")
    )
    quantiles = F.array(*[_interpolated(i) for i in range(len(probabilities))])
    return per_group.select(*group_cols, "n", quantiles.alias("quantiles"))


def _written(df: DataFrame) -> DataFrame:
    path = fresh_path(df.sparkSession, "quantiles")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _first_targets(
    values: DataFrame, keys: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """A row per group, quantile and neighbouring rank, with the interval it lies in.

    The interval is ``_low`` to ``_high``, both included, holds ``_size`` distinct values, and
    has ``_start`` values of the group before it.
    """
    groups = values.groupBy(*keys).agg(
        F.sum("_count").alias("n"),
        F.min("_v").alias("_low"),
        F.max("_v").alias("_high"),
        F.count(F.lit(1)).alias("_size"),
    )
    positions = F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in probabilities])
    floor = F.floor("_position")
    return groups.select("*", F.posexplode(positions).alias("_i", "_position")).select(
        *keys,
        "n",
        "_low",
        "_high",
        "_size",
        F.lit(0).cast("long").alias("_start"),
        "_i",
        (F.col("_position") - floor).alias("_share"),
        F.explode(F.array_distinct(F.array(floor, F.ceil("_position")))).alias("_rank"),
    )


def _inside(values: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values that lie in a wanted interval, with its bounds and ``_start``."""
    cell = F.struct("_low", "_high", "_start")
    cells = targets.groupBy(*keys).agg(F.collect_set(cell).alias("_cells"))
    value = F.col("_v")
    mine = F.filter("_cells", lambda c: (c["_low"] <= value) & (value <= c["_high"]))
    columns = values.columns
    opened = _with_group(values, cells, keys).select(*columns, F.explode(mine).alias("_cell"))
    return opened.select(*columns, "_cell._low", "_cell._high", "_cell._start")


def _narrowed(
    values: DataFrame, targets: DataFrame, keys: Sequence[str], most_ranked: int
) -> DataFrame:
    """The targets, those in large intervals with the part that holds their rank."""
    large = targets.filter(F.col("_size") > most_ranked)
    inside = _inside(values, large, keys)
    points = [(k + 1) / (_SPLITS + 1) for k in range(_SPLITS)]
    cell = [*keys, "_low"]
    splits = inside.groupBy(*cell).agg(
        F.percentile_approx("_v", points, _ACCURACY).alias("_splits")
    )
    # As arrays per group again, which keeps hot groups from being joined in one task.
    per_group = splits.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_low", "_splits"))).alias("_by_low")
    )
    guided = _with_group(inside, per_group, keys).withColumn(
        "_splits", F.col("_by_low")[F.col("_low")]
    )
    # The middle of the interval, by magnitude, is a split point too: should the sketch's be
    # of no use, the interval shrinks all the same.
    middle = F.sinh(F.asinh("_low") / 2 + F.asinh("_high") / 2)
    place = 2 * _place(_SPLITS) + (F.col("_v") > middle).cast("int")
    parts = guided.groupBy(*cell, "_start", place.alias("_place")).agg(
        F.min("_v").alias("_from"),
        F.max("_v").alias("_to"),
        F.sum("_count").alias("_count"),
        F.count(F.lit(1)).alias("_values"),
    )
    order = Window.partitionBy(*cell).orderBy("_place")
    parts = parts.withColumn("_before", F.col("_start") + _count_before(order))
    wanted = large.select(*cell, "n", "_i", "_share", "_rank")
    wanted = wanted.withColumnsRenamed({c: f"r_{c}" for c in cell})
    moved = parts.join(wanted, _same(cell)).filter(_holds_rank())
    return targets.filter(F.col("_size") <= most_ranked).unionByName(
        moved.select(
            *keys,
            "n",
            F.col("_from").alias("_low"),
            F.col("_to").alias("_high"),
            F.col("_values").alias("_size"),
            F.col("_before").alias("_start"),
            "_i",
            "_share",
            "_rank",
        )
    )


def _with_group(rows: DataFrame, per_group: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their group's columns; null is a group of its own.

    Null-safe keys are also what has both sides shuffled right before the join, so adaptive
    execution can split a hot group.
    """
    if keys == ["_all"]:  # one group: its single row is a scalar subquery
        columns = [name for name in per_group.columns if name not in keys]
        return rows.withColumns({name: per_group.select(name).scalar() for name in columns})
    right = per_group.withColumnsRenamed({key: f"r_{key}" for key in keys})
    return rows.join(right, _same(keys)).drop(*[f"r_{key}" for key in keys])


def _count_before(ordered: WindowSpec) -> Column:
    preceding = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_count").over(preceding), F.lit(0))


def _interpolated(i: int) -> Column:
    """Quantile i of a group's found values: one, or the two neighbours of its position."""
    mine = F.filter("_found", lambda f: f["_i"] == i)
    values = F.transform(mine, lambda f: f["_v"])
    low, high = F.array_min(values), F.array_max(values)
    return low + (high - low) * F.get(mine, F.lit(0))["_share"]


def _place(count: int) -> Column:
    """Number of split points that lie before the value; they are in order."""
    splits, value = F.col("_splits"), F.col("_v")
    low = F.lit(0)
    step = 1 << (count.bit_length() - 1)
    while step:  # binary search: 127 points take seven steps
        low = low + F.when(F.get(splits, low + (step - 1)) < value, step).otherwise(0)
        step >>= 1
    return low


def _holds_rank() -> Column:
    rank, before = F.col("_rank"), F.col("_before")
    return (rank >= before) & (rank < before + F.col("_count"))


def _same(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"r_{key}"))
    return same

"""Dashboard datasets: the query each chart's field wells stand for, over any view."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.operators.quantiles import exact_quantiles

# Accepted aggregation names of a measure.
AGGREGATIONS = {
    "SUM": F.sum,
    "AVERAGE": F.avg,
    "MIN": F.min,
    "MAX": F.max,
    "COUNT": F.count,
    "DISTINCT_COUNT": F.count_distinct,
}

# Accepted grains of a date dimension.
GRAINS = ["YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND", "MILLISECOND"]

ALL_VALUES, NULLS_ONLY, NON_NULLS_ONLY = "ALL_VALUES", "NULLS_ONLY", "NON_NULLS_ONLY"


def measure(column: str, aggregation: str, name: str | None = None) -> Column:
    """Aggregated measure of a column; the name defaults to ``<column>_<aggregation>``."""
    if aggregation not in AGGREGATIONS:
        raise ValueError(f"unknown aggregation {aggregation!r}")
    return AGGREGATIONS[aggregation](F.col(column)).alias(name or f"{column}_{aggregation.lower()}")


@dataclass(frozen=True)
class Percentile:
    """Measure: a percentile of a column, interpolated between neighbouring values."""

    column: str
    percent: float
    name: str


def percentile_measure(column: str, percent: float, name: str | None = None) -> Percentile:
    """Percentile measure; the name defaults to ``<column>_p<percent>``."""
    if not 0 <= percent <= 100:
        raise ValueError(f"no percentile: {percent!r}")
    return Percentile(column, percent, name or f"{column}_p{percent:g}".replace(".", "_"))


def calculated_measure(expression: str, name: str) -> Column:
    """Measure given as an aggregate expression over ``{field}`` references."""
    return F.expr(_with_fields(expression)).alias(name)


def _with_fields(expression: str) -> str:
    return expression.replace("{", "`").replace("}", "`")


def date_granularity(column: str, grain: str, name: str | None = None) -> Column:
    """Date dimension cut to a grain."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    return F.date_trunc(grain, F.col(column)).alias(name or column)


def agg_dataset(
    df: DataFrame,
    dimensions: Sequence[str | Column],
    measures: Sequence[Column | Percentile],
) -> DataFrame:
    """Measures by dimensions, as behind bar, line, pie, funnel, tree map and table visuals.

    Percentiles are found apart, which takes jobs, and joined to the other measures by the
    dimensions; null is a group like any other.
    """
    plain = [m for m in measures if not isinstance(m, Percentile)]
    if len(plain) == len(measures):
        return df.groupBy(*dimensions).agg(*measures)
    groups = df.groupBy(*dimensions).agg(*plain, F.count(F.lit(1)).alias("_rows"))
    names = groups.columns[: len(dimensions)]
    given = iter(groups.columns[len(dimensions) :])
    order = [m.name if isinstance(m, Percentile) else next(given) for m in measures]
    keys = [f"_key{i}" for i in range(len(dimensions))]
    keyed = df.select(
        "*",
        *[
            (F.col(d) if isinstance(d, str) else d).alias(key)
            for d, key in zip(dimensions, keys, strict=True)
        ],
    )
    wanted: dict[str, list[Percentile]] = {}
    for m in measures:
        if isinstance(m, Percentile):
            wanted.setdefault(m.column, []).append(m)
    for column, some in wanted.items():
        shares = [m.percent / 100 for m in some]
        found = exact_quantiles(keyed, keys, column, shares).select(
            *keys, *[F.col("quantiles")[i].alias(m.name) for i, m in enumerate(some)]
        )
        if keys:
            same = [groups[n].eqNullSafe(found[k]) for n, k in zip(names, keys, strict=True)]
            groups = groups.join(found, same, "left").drop(*keys)
        else:
            groups = groups.withColumns({m.name: found.select(m.name).scalar() for m in some})
    return groups.select(*[f"`{n}`" for n in [*names, *order]])


def calculated_field(df: DataFrame, name: str, expression: str) -> DataFrame:
    """Add a row expression over ``{field}`` references."""
    return df.withColumn(name, F.expr(_with_fields(expression)))


def _with_nulls(condition: Column, value: Column, null_option: str) -> Column:
    if null_option == ALL_VALUES:
        return condition | value.isNull()
    if null_option == NULLS_ONLY:
        return value.isNull()
    if null_option == NON_NULLS_ONLY:
        return condition & value.isNotNull()
    raise ValueError(f"unknown null option {null_option!r}")


def category_filter(
    df: DataFrame,
    column: str,
    match_operator: str,
    values: str | Sequence[str],
    null_option: str = NON_NULLS_ONLY,
) -> DataFrame:
    """Keep rows by comparing a category with one value or a list.

    EQUALS and CONTAINS keep a row that matches any of the values, DOES_NOT_EQUAL and
    DOES_NOT_CONTAIN one that matches none. Against a list, CONTAINS means membership.
    """
    value = F.col(column)
    if isinstance(values, str):
        one_of, contains = value == values, value.contains(values)
    else:
        one_of = contains = value.isin(list(values))
    conditions = {
        "EQUALS": one_of,
        "DOES_NOT_EQUAL": ~one_of,
        "CONTAINS": contains,
        "DOES_NOT_CONTAIN": ~contains,
        "STARTS_WITH": value.startswith(values) if isinstance(values, str) else None,
        "ENDS_WITH": value.endswith(values) if isinstance(values, str) else None,
    }
    condition = conditions.get(match_operator)
    if condition is None:
        raise ValueError(f"match operator {match_operator!r} does not apply to {values!r}")
    return df.filter(_with_nulls(condition, value, null_option))


def numeric_equality_filter(
    df: DataFrame,
    column: str,
    match_operator: str,
    number: float,
    null_option: str = NON_NULLS_ONLY,
) -> DataFrame:
    """Keep rows whose number equals, or does not equal, the given one."""
    value = F.col(column)
    conditions = {"EQUALS": value == number, "DOES_NOT_EQUAL": value != number}
    if match_operator not in conditions:
        raise ValueError(f"unknown match operator {match_operator!r}")
    return df.filter(_with_nulls(conditions[match_operator], value, null_option))


def aggregated_filter(
    df: DataFrame,
    dimensions: Sequence[str | Column],
    measures: Sequence[Column | Percentile],
    filtered: Column | Percentile,
    match_operator: str,
    number: float,
    null_option: str = NON_NULLS_ONLY,
) -> DataFrame:
    """Aggregated dataset of the groups whose ``filtered`` measure equals, or not, a number."""
    if isinstance(filtered, Percentile):
        last = replace(filtered, name="_filtered")
    else:
        last = filtered.alias("_filtered")
    grouped = agg_dataset(df, dimensions, [*measures, last])
    kept = numeric_equality_filter(grouped, "_filtered", match_operator, number, null_option)
    return kept.drop("_filtered")


def time_range_filter(
    df: DataFrame,
    column: str,
    minimum=None,
    maximum=None,
    include_minimum: bool = True,
    include_maximum: bool = True,
    null_option: str = NON_NULLS_ONLY,
    grain: str | None = None,
    exclude_last: tuple[int, str] | None = None,
    until=None,
) -> DataFrame:
    """Keep rows inside a time range; either bound may be open, inclusive or not.

    With ``grain`` times are compared as the start of their period. ``exclude_last`` is a
    number of periods of a grain: the period that holds ``until`` and those before it, so
    many in all, are left out, and what follows them too.
    """
    value = F.col(column) if grain is None else date_granularity(column, grain)
    condition = F.lit(True)
    if exclude_last is not None:
        count, unit = exclude_last
        if unit not in GRAINS or until is None:
            raise ValueError("exclude_last takes (number, grain) and a time to count back from")
        opened = F.date_trunc(unit, F.lit(until))
        first_left_out = F.timestamp_add(unit, F.lit(1 - count), opened)
        condition = F.col(column) < first_left_out
    if minimum is not None:
        low = F.lit(minimum)
        condition = condition & (value >= low if include_minimum else value > low)
    if maximum is not None:
        high = F.lit(maximum)
        condition = condition & (value <= high if include_maximum else value < high)
    return df.filter(_with_nulls(condition, value, null_option))


def row_sort(df: DataFrame, *fields: tuple[str, str]) -> DataFrame:
    """Sort a dataset by (field, ASC or DESC) pairs."""
    orders = {"ASC": F.asc, "DESC": F.desc}
    return df.orderBy(*[orders[direction](field) for field, direction in fields])


def unaggregated_table(
    df: DataFrame,
    columns: Sequence[str],
    date_formats: dict[str, str] | None = None,
    null_text: str = "",
) -> DataFrame:
    """Raw rows, with formatted dates and a text in place of missing ones."""
    formats = date_formats or {}
    return df.select(
        *[
            F.coalesce(F.date_format(name, formats[name]), F.lit(null_text)).alias(name)
            if name in formats
            else F.col(name)
            for name in columns
        ]
    )


def heat_map(
    df: DataFrame,
    rows: Sequence[str],
    columns: str,
    measures: Sequence[Column],
    column_values: Sequence | None = None,
) -> DataFrame:
    """Matrix of a measure, one row per cell; listed column values give a wide matrix.

    Values that are not listed have no column there; ``open_pivot`` keeps them.
    """
    if column_values is None:
        return df.groupBy(*rows, columns).agg(*measures)
    return df.groupBy(*rows).pivot(columns, list(column_values)).agg(*measures)


def open_pivot(
    df: DataFrame,
    rows: Sequence[str],
    columns: str,
    value: str,
    aggregation: str,
    most_columns: int = 20,
    other: str = "other",
    missing: str = "none",
    total: str = "total",
) -> DataFrame:
    """Wide matrix over column values that nobody listed.

    A first pass finds the ``most_columns`` most frequent values, ties in the order of the
    text; the second gives each of them a column and all others one together. Missing values
    have a column too, and the total is taken over all rows, so nothing is left out. The
    columns are named by the values' text, and stand in the order of their frequency.
    """
    if aggregation not in AGGREGATIONS:
        raise ValueError(f"unknown aggregation {aggregation!r}")
    text = F.col(columns).cast("string")
    counts = df.filter(text.isNotNull()).groupBy(text.alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    found = counts.orderBy(F.desc("n"), "value").limit(most_columns).collect()
    values = [r["value"] for r in found]
    names = [*values, other, missing, total]
    if len({n.lower() for n in [*names, *rows]}) < len(names) + len(rows):
        raise ValueError(f"columns of one name: {[*rows, *names]}")
    aggregate, cell = AGGREGATIONS[aggregation], F.col(value)
    listed = text.isin(values) if values else F.lit(False)
    return df.groupBy(*rows).agg(
        *[aggregate(F.when(text == v, cell)).alias(v) for v in values],
        aggregate(F.when(text.isNotNull() & ~listed, cell)).alias(other),
        aggregate(F.when(text.isNull(), cell)).alias(missing),
        aggregate(cell).alias(total),
    )


def box_plot(df: DataFrame, group_cols: Sequence[str], value: str) -> DataFrame:
    """Number of values, minimum, quartiles and maximum per group."""
    names = ["minimum", "first_quartile", "median", "third_quartile", "maximum"]
    found = exact_quantiles(df, group_cols, value, [0.0, 0.25, 0.5, 0.75, 1.0])
    return found.select(
        *group_cols, "n", *[F.col("quantiles")[i].alias(name) for i, name in enumerate(names)]
    )


def kpi_target(df: DataFrame, value: Column, target: Column) -> DataFrame:
    """One measure of the whole dataset against another: value, target and their ratio."""
    totals = df.agg(value.alias("value"), target.alias("target"))
    return totals.withColumn("progress", F.try_divide("value", "target"))


def kpi_trend(
    df: DataFrame, value: Column, target: Column, trend: str, grain: str
) -> DataFrame:
    """The same for each period of a trend group."""
    totals = df.groupBy(date_granularity(trend, grain, "period")).agg(
        value.alias("value"), target.alias("target")
    )
    return totals.withColumn("progress", F.try_divide("value", "target"))


def quartile_band(df: DataFrame, value: str, band: str = "band") -> DataFrame:
    """Mark aggregated rows as TOP_25_PERCENT, BOTTOM_25_PERCENT or MIDDLE by a measure."""
    cuts = exact_quantiles(df, [], value, [0.25, 0.75]).select("quantiles").scalar()
    banded = df.withColumn("_cuts", cuts)
    measured = F.col(value).cast("double")
    return banded.withColumn(
        band,
        F.when(measured > F.col("_cuts")[1], "TOP_25_PERCENT")
        .when(measured < F.col("_cuts")[0], "BOTTOM_25_PERCENT")
        .when(measured.isNotNull(), "MIDDLE"),
    ).drop("_cuts")


def hierarchy_rollup(
    df: DataFrame, hierarchy: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """Measures at each level of a drill-down hierarchy; level 0 is the grand total."""
    depth = len(hierarchy)
    # A rolled-up column sets its bit, so the bits left are those of the level's columns.
    level = F.lit(depth) - F.bit_count(F.grouping_id())
    return df.rollup(*hierarchy).agg(*measures, level.cast("int").alias("level"))


def scatter_points(
    df: DataFrame,
    category: Sequence[str],
    x: Column,
    y: Column,
    aggregated: bool = True,
) -> DataFrame:
    """Points of a scatter plot: one per category, or one per row."""
    if aggregated:
        return df.groupBy(*category).agg(x.alias("x"), y.alias("y"))
    return df.select(*category, x.alias("x"), y.alias("y"))

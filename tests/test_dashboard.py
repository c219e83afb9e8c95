import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealscope.operators.quantiles import exact_quantiles
from dealscope.plans import dashboard

from .frames import utc

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


def check(spark, groups, probabilities=PROBABILITIES):
    data = [(g, float(v)) for g, values in groups.items() for v in values]
    random.Random(7).shuffle(data)
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    found = exact_quantiles(df, ["g"], "v", probabilities).collect()
    assert {r["g"] for r in found} == set(groups)
    for row in found:
        expected = np.quantile(groups[row["g"]], probabilities)
        assert row["n"] == len(groups[row["g"]])
        np.testing.assert_allclose(row["quantiles"], expected, rtol=1e-12)


def test_quantiles_equal_brute_force(spark):
    rng = random.Random(1)
    check(
        spark,
        {
            "one": [3.5],
            "two": [1, 2],
            "same": [4] * 1000,
            "ties": [rng.randint(0, 3) for _ in range(5000)],
            "mostly one value": [0] * 4000 + [rng.random() for _ in range(1000)],
            "wide": [rng.lognormvariate(0, 9) for _ in range(20_000)],
            "negative": [-rng.random() for _ in range(999)],
            None: [1, 5, 9],
        },
    )


def test_quantiles_do_not_depend_on_the_sketch(spark, monkeypatch):
    from dealscope.operators import quantiles

    monkeypatch.setattr(quantiles, "_ACCURACY", 2)  # split points far off
    rng = random.Random(2)
    check(spark, {"a": [rng.random() for _ in range(5000)], "b": list(range(100))})


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert exact_quantiles(df, ["g"], "v", [0.5]).count() == 0
    assert exact_quantiles(df, [], "v", [0.5]).count() == 0


def test_bands(spark):
    df = spark.createDataFrame([(i, i) for i in range(1, 10)] + [(0, None)], "k int, v int")
    bands = {r["k"]: r["band"] for r in dashboard.quartile_band(df, "v").collect()}
    assert bands == {
        0: None,
        **{k: "BOTTOM_25_PERCENT" for k in (1, 2)},
        **{k: "MIDDLE" for k in (3, 4, 5, 6, 7)},
        **{k: "TOP_25_PERCENT" for k in (8, 9)},
    }


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [
            ("Alchemy", 10.0, 4.0, utc("2024-01-15")),
            ("Alchemy", 5.0, 1.0, utc("2024-02-15")),
            ("OneView", 7.0, 9.0, utc("2024-02-16")),
            (None, 1.0, 1.0, None),
        ],
        "product string, sales double, profit double, ordered timestamp",
    )


def products(df):
    return sorted((r["product"] or "-") for r in df.collect())


def test_category_filters(sales):
    f = dashboard.category_filter
    assert products(f(sales, "product", "CONTAINS", ["Alchemy"])) == ["Alchemy", "Alchemy"]
    assert products(f(sales, "product", "CONTAINS", "View")) == ["OneView"]
    assert products(f(sales, "product", "DOES_NOT_EQUAL", "OneView")) == ["Alchemy", "Alchemy"]
    assert products(f(sales, "product", "DOES_NOT_CONTAIN", ["Alchemy"], "ALL_VALUES")) == [
        "-",
        "OneView",
    ]
    assert products(f(sales, "product", "STARTS_WITH", "One")) == ["OneView"]
    assert products(f(sales, "product", "EQUALS", "x", "NULLS_ONLY")) == ["-"]
    with pytest.raises(ValueError):
        f(sales, "product", "STARTS_WITH", ["a"])
    with pytest.raises(ValueError):
        f(sales, "product", "EQUALS", "x", "SOME")


def test_other_filters(sales):
    equal = dashboard.numeric_equality_filter
    assert products(equal(sales, "sales", "EQUALS", 7)) == ["OneView"]
    assert len(products(equal(sales, "sales", "DOES_NOT_EQUAL", 7))) == 3
    between = dashboard.time_range_filter
    low, high = utc("2024-01-15"), utc("2024-02-15")
    assert len(products(between(sales, "ordered", low, high))) == 2
    assert len(products(between(sales, "ordered", low, high, False, False))) == 0
    assert products(between(sales, "ordered", high, null_option="ALL_VALUES")) == [
        "-",
        "Alchemy",
        "OneView",
    ]


def test_fields_and_measures(sales):
    cost = dashboard.calculated_field(sales, "Cost", "{sales} - {profit}")
    measures = [
        dashboard.measure("Cost", "SUM"),
        dashboard.calculated_measure("sum({profit}) / sum({sales})", "margin"),
    ]
    found = dashboard.agg_dataset(cost, ["product"], measures)
    ordered = dashboard.row_sort(found, ("Cost_sum", "DESC"), ("product", "ASC"))
    assert [tuple(r) for r in ordered.collect()] == [
        ("Alchemy", 10.0, 5 / 15),
        (None, 0.0, 1.0),
        ("OneView", -2.0, 9 / 7),
    ]
    with pytest.raises(ValueError):
        dashboard.measure("sales", "SUMMIT")
    with pytest.raises(ValueError):
        dashboard.date_granularity("ordered", "FORTNIGHT")


def test_tables_and_targets(sales):
    table = dashboard.unaggregated_table(sales, ["product", "ordered"], {"ordered": "yyyy"}, "none")
    assert {r["ordered"] for r in table.collect()} == {"2024", "none"}
    row = dashboard.kpi_target(sales, F.sum("profit"), F.sum("sales")).first()
    assert tuple(row) == (15.0, 23.0, 15 / 23)
    nothing = dashboard.kpi_target(sales, F.sum("profit"), F.sum(F.lit(0))).first()
    assert nothing["progress"] is None


def test_rollup_levels_tell_totals_from_nulls(sales):
    found = dashboard.hierarchy_rollup(sales, ["product"], [F.sum("sales").alias("sales")])
    assert sorted((r["level"], r["product"] or "-", r["sales"]) for r in found.collect()) == [
        (0, "-", 23.0),
        (1, "-", 1.0),
        (1, "Alchemy", 15.0),
        (1, "OneView", 7.0),
    ]


def test_scatter_points_raw_and_aggregated(sales):
    raw = dashboard.scatter_points(sales, ["product"], F.col("sales"), F.col("profit"), False)
    assert raw.count() == 4
    assert dashboard.scatter_points(sales, ["product"], F.sum("sales"), F.sum("profit")).count() == 3


def test_quantiles_by_refinement_equal_brute_force(spark, monkeypatch):
    from dealscope.operators import quantiles

    rng = np.random.default_rng(6)
    groups = {
        "a": np.exp(rng.normal(0, 20, 300)),
        "b": np.round(rng.normal(0, 3, 400), 1),
        None: np.r_[np.full(300, 5.0), rng.normal(5, 1e-9, 100)],
        "one": np.array([7.0]),
    }
    data = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "g string, v double").repartition(3)
    wanted = [0.0, 0.1, 0.5, 0.901, 1.0]
    narrowed = []
    step = quantiles._narrowed
    monkeypatch.setattr(
        quantiles, "_narrowed", lambda *args: narrowed.append(1) or step(*args)
    )
    for accuracy, most in ((2000, 9), (2, 120)):
        monkeypatch.setattr(quantiles, "_ACCURACY", accuracy)
        found = exact_quantiles(df, ["g"], "v", wanted, most_ranked=most).collect()
        assert len(found) == 4
        for row in found:
            values = groups[row["g"]]
            assert row["n"] == len(values)
            np.testing.assert_allclose(row["quantiles"], np.quantile(values, wanted), rtol=1e-12)
    assert len(narrowed) >= 2
    (row,) = exact_quantiles(df, [], "v", [0.3], most_ranked=50).collect()
    every = np.concatenate(list(groups.values()))
    np.testing.assert_allclose(row["quantiles"], [np.quantile(every, 0.3)], rtol=1e-12)


def test_percentiles_stand_beside_other_measures(spark):
    rows = [("x", 1.0, 1), ("x", 3.0, 2), (None, 10.0, 3), ("y", None, 4), ("x", None, 5)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    measures = [
        dashboard.percentile_measure("v", 50),
        dashboard.measure("w", "SUM"),
        dashboard.percentile_measure("v", 75, "upper"),
        dashboard.percentile_measure("w", 0),
    ]
    found = dashboard.agg_dataset(df, ["g"], measures)
    assert found.columns == ["g", "v_p50", "w_sum", "upper", "w_p0"]
    assert {tuple(r) for r in found.collect()} == {
        ("x", 2.0, 8, 2.5, 1.0), (None, 10.0, 3, 10.0, 3.0), ("y", None, 4, None, 4.0),
    }
    (total,) = dashboard.agg_dataset(df, [], measures[:2]).collect()
    assert tuple(total) == (3.0, 15)
    kept = dashboard.aggregated_filter(df, ["g"], [dashboard.measure("w", "SUM")], measures[0], "EQUALS", 2)
    assert [tuple(r) for r in kept.collect()] == [("x", 8)]
    with pytest.raises(ValueError):
        dashboard.percentile_measure("v", 101)


def test_open_pivot_leaves_nothing_out(spark):
    rows = [("a", "p", 1), ("a", "q", 2), ("a", None, 4), ("b", "p", 8), ("b", "r", 16), (None, "s", 32)]
    df = spark.createDataFrame(rows, "g string, c string, v long")
    found = dashboard.open_pivot(df, ["g"], "c", "v", "SUM", most_columns=2)
    assert found.columns == ["g", "p", "q", "other", "none", "total"]
    assert {tuple(r) for r in found.collect()} == {
        ("a", 1, 2, None, 4, 7), ("b", 8, None, 16, None, 24), (None, None, None, 32, None, 32),
    }
    with pytest.raises(ValueError):
        dashboard.open_pivot(df, ["g"], "c", "v", "SUM", other="P")

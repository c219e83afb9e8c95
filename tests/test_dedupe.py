from functools import reduce

import pytest
from pyspark.sql import functions as F

from dealscope.operators.dedupe import merge_dedupe


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, at string, v int")


def kept(df):
    return {r["id"]: r["v"] for r in df.collect()}


def test_last_input_wins_and_keyless_rows_drop_out(spark):
    a = frame(spark, ("1", "2024-01-02", 1), (None, "x", 2), ("2", None, 3))
    b = frame(spark, ("1", "2024-01-01", 4))
    assert kept(merge_dedupe([a, b])) == {"1": 4, "2": 3}


def test_greatest_timestamp_keeps_the_earlier_on_ties_and_nulls(spark):
    a = frame(spark, ("1", "2024-01-02", 1), ("2", "2024-01-02", 2), ("3", None, 3), ("4", None, 4))
    b = frame(spark, ("1", "2024-01-01", 5), ("2", "2024-01-02", 6), ("3", "2024-01-01", 7), ("4", None, 8))
    found = merge_dedupe([a, b], timestamp=F.to_timestamp("at"))
    assert kept(found) == {"1": 1, "2": 2, "3": 7, "4": 4}


def test_key_expression(spark):
    a = frame(spark, ("1", None, 1), ("01", None, 2))
    found = merge_dedupe([a], F.col("id").cast("int"), position=[F.col("v")])
    assert [r["v"] for r in found.collect()] == [2]


def test_score_keeps_the_earlier_of_equals(spark):
    a = frame(spark, ("1", "aa", 1), ("1", "bb", 2), ("2", None, 3))
    b = frame(spark, ("1", "c", 4), ("2", "x", 5))
    found = merge_dedupe([a, b], position=[F.col("v")], resolver=F.length("at"))
    assert kept(found) == {"1": 1, "2": 5}


FOLDS = {
    "first": lambda old, new: old,
    "last": lambda old, new: new,
    "first_filled": lambda old, new: old if old not in (None, "") else new,
    "last_filled": lambda old, new: new if new not in (None, "") else old,
    "min": lambda old, new: min((x for x in (old, new) if x is not None), default=None),
    "max": lambda old, new: max((x for x in (old, new) if x is not None), default=None),
    "sum": lambda old, new: (old or 0) + (new or 0),
}


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_every_way_equals_a_fold_in_order(spark, partitions):
    n = 12_000
    number = F.col("id")
    value = F.when(number % 7 != 3, (number * 7919 % 1009).cast("int"))
    rows = spark.range(n).select(
        F.when(number % 100 == 0, number.cast("string")).otherwise("hot").alias("id"),
        number.alias("at"),
        *[value.alias(way) for way in FOLDS],
    )
    found = merge_dedupe(
        [rows.repartition(partitions)], position=[F.col("at")], resolver={w: w for w in FOLDS}
    )
    hot = found.filter("id = 'hot'").first()
    values = [None if i % 7 == 3 else i * 7919 % 1009 for i in range(n) if i % 100]
    for way, fold in FOLDS.items():
        assert hot[way] == reduce(fold, values), way
    assert hot["at"] == n - 1
    assert found.count() == n // 100 + 1


def test_functions_and_unknown_ways_are_rejected(spark):
    a = frame(spark, ("1", "x", 1))
    with pytest.raises(TypeError):
        merge_dedupe([a], resolver=lambda old, new: new)
    with pytest.raises(ValueError):
        merge_dedupe([a], resolver={"v": "median"})
    with pytest.raises(ValueError):
        merge_dedupe([a], resolver={"w": "max"})

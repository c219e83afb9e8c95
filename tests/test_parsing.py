from pyspark.sql import functions as F

from dealscope.functions import parsing

from .frames import utc


def parsed(spark, function, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", F.unix_micros(function(F.col("t"))).alias("v")).orderBy("i").collect()
    return [row["v"] for row in rows]


def micros(text):
    return int(utc(text).timestamp()) * 1_000_000


def test_mixed_timestamps(spark):
    cases = {
        "1700000000000": 1_700_000_000_000_000,
        "1700000000123": 1_700_000_000_123_000,
        "0": 0,
        "2024": 2_024_000,
        "2024-01-05T10:00:00Z": micros("2024-01-05T10:00:00"),
        "2024-01-05T10:00:00.250Z": micros("2024-01-05T10:00:00") + 250_000,
        "2024-01-05T10:00:00+03:00": micros("2024-01-05T07:00:00"),
        "2024-01-05": micros("2024-01-05T00:00:00"),
        " 2024-01-05 ": micros("2024-01-05T00:00:00"),
        "": None,
        None: None,
        "junk": None,
        "12:30": None,
        "2024-13-01": None,
        "-5": None,
        "99999999999999999999": None,
        "9223372036855": None,
    }
    assert parsed(spark, parsing.parse_mixed_timestamp, cases) == list(cases.values())


def test_iso_only_ignores_epoch_numbers(spark):
    assert parsed(spark, parsing.iso_to_utc, ["1700000000000", "2024-01-05"]) == [
        None,
        micros("2024-01-05T00:00:00"),
    ]


def test_first_filled_skips_null_and_empty(spark):
    df = spark.createDataFrame(
        [(None, "", "c"), ("", "b", "c"), ("a", None, None), (None, "", None)],
        "a string, b string, c string",
    )
    found = df.select(parsing.first_filled(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [row[0] for row in found] == ["c", "b", "a", None]


def test_timestamp_text_has_milliseconds(spark):
    df = spark.range(1).select(
        parsing.iso_text(F.timestamp_micros(F.lit(1_700_000_000_123_456))).alias("t")
    )
    assert df.first()["t"] == "2023-11-14T22:13:20.123Z"

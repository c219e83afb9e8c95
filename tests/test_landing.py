"""What the queries of the sync jobs land, on rows of their own."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

import queries
from dealscope import adapter
from dealscope.session import fresh_path, shared_folder


@pytest.fixture
def orders(spark, tmp_path):
    """Forty orders, the even ones delivered; with the other tables of the deals."""
    k = F.col("id")
    spark.range(1, 41).select(
        k.alias("o_orderkey"),
        (k % 7).alias("o_custkey"),
        F.when(k % 2 == 0, "F").otherwise("O").alias("o_orderstatus"),
        (k * 1.5).cast("double").alias("o_totalprice"),
        F.lit("1998-02-06 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(3).select(
        k.alias("s_suppkey"),
        F.lit("s").alias("s_name"),
        F.lit(0).alias("s_nationkey"),
        F.lit(0.0).alias("s_acctbal"),
    ).write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def _landings(spark, folder, name, monkeypatch):
    """Rows of a query, and the landed texts with the files they came from."""
    monkeypatch.setattr(queries, "fresh_path", lambda spark, kind: fresh_path(spark, f"{tag}-{kind}"))
    tag = uuid.uuid4().hex
    found = queries.QUERIES[name](spark, folder).collect()
    texts = spark.read.option("recursiveFileLookup", True).text(
        f"{shared_folder(spark)}/dealscope/{tag}-raw-deals-*"
    )
    file = F.col("_metadata.file_path")
    return found, texts.select("value", file.alias("file")).collect()


def test_later_objects_land_beside_the_first_ones_compressed(spark, orders, monkeypatch):
    found, landed = _landings(spark, orders, "j01_sync_deals", monkeypatch)
    assert len(found) == len({r["deal_id"] for r in found}) == 40
    edited = {r["deal_id"] for r in found if r["deal_name"] == "edited"}
    assert edited == {str(k) for k in range(5, 41, 5)}
    # 40 objects, 8 second versions, 8 outdated versions; then 16 edited ones. None is dated
    # in the future but number 1.
    assert len(landed) == 40 + 8 + 8 + 16
    assert all(r["file"].endswith(".snappy") for r in landed)
    folders = [r["file"].rpartition("/")[0] for r in landed]
    assert sorted(map(folders.count, set(folders))) == [16, 56]


def test_objects_land_as_their_texts_are(spark, orders, monkeypatch):
    _, landed = _landings(spark, orders, "j06_monthly_kpis_kept_up", monkeypatch)
    texts = [r["value"] for r in landed if "landed=2024-08-31" in r["file"]]
    assert sorted(texts) == sorted(r["value"] for r in adapter.raw_deals(spark, orders).collect())
    assert all(r["file"].endswith(".snappy") for r in landed) and len(landed) == 48 + 16


def test_raw_objects_of_some_numbers(spark, orders):
    some = adapter.raw_deals(spark, orders, F.col("k") % 5 == 0).collect()
    every = adapter.raw_deals(spark, orders).collect()
    number = lambda r: int(json.loads(r["value"])["id"])
    assert sorted(r["value"] for r in some) == sorted(r["value"] for r in every if number(r) % 5 == 0)

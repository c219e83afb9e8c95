import base64
import gzip
import hashlib
import io
import json
import zlib

import pytest
from pyspark.sql import functions as F

from dealscope.llm import warc as W


def pages(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, html string, payload_bytes string")
    return frame.select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))


def test_round_trip(spark):
    big = "".join(chr(33 + i * i % 90) for i in range(3_000_000))
    texts = ["a", "b", "a", None, "", "a", "WARC/1.1\r\n\r\né", big, big, "b", "c"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(10, "c", "again")]
    out = W.read_records(W.archive_pages(pages(spark, rows))).collect()
    assert sorted(r["page_id"] for r in out) == sorted(r[0] for r in rows)
    last = {t or "": i for i, t, _ in rows}
    for r in out:
        payload = (texts[r["page_id"]] or "").encode()
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        winner = last[payload.decode()]
        if winner == r["page_id"]:
            assert (r["record_type"], r["refers_to"]) == ("response", None)
            assert r["payload"] == payload
        else:
            assert (r["record_type"], r["refers_to"]) == ("revisit", winner)


def test_small_payloads_are_no_revisits_above_a_minimum(spark):
    frame = pages(spark, [(1, "aa", ""), (2, "aa", ""), (3, "bbbb", ""), (4, "bbbb", "")])
    out = W.read_records(W.archive_pages(frame, payload_min=3)).collect()
    assert {r["page_id"]: r["refers_to"] for r in out} == {1: None, 2: None, 3: 4, 4: None}


def test_null_ids_and_no_rows(spark):
    frame = pages(spark, [(None, "a", ""), (5, "a", ""), (None, "b", "")])
    out = W.read_records(W.archive_pages(frame)).collect()
    assert sorted((str(r["page_id"]), str(r["refers_to"])) for r in out) == [
        ("5", "None"), ("None", "5"), ("None", "None"),
    ]
    assert W.read_records(W.archive_pages(frame.where("false"))).count() == 0


def test_archives_are_one_member_and_then_one_for_each_record(spark, tmp_path):
    frame = pages(spark, [(i, f"page {i} " * 50, "") for i in range(40)])
    rows = W.with_revisits(frame).coalesce(1)
    manifest = W.write_archives(rows, f"file://{tmp_path}/whole", archive_bytes=8_000).collect()
    assert len(manifest) > 1 and sum(r["n_records"] for r in manifest) == 40
    for r in manifest:
        data = open(r["path"].removeprefix("file://"), "rb").read()
        member = zlib.decompressobj(31)
        member.decompress(data)
        assert member.eof and not member.unused_data
    paths = spark.createDataFrame([(r["path"],) for r in manifest], "path string")
    index = W.normalise_archives(paths, f"file://{tmp_path}/members").collect()
    assert len(index) == 40
    for r in index:
        with open(r["path"].removeprefix("file://"), "rb") as f:
            f.seek(r["offset"])
            assert gzip.decompress(f.read(r["length"])).startswith(b"WARC/1.1\r\n")
    sidecars = list((tmp_path / "members").glob("*.cdxj"))
    lines = [json.loads(x.split(" ", 1)[1]) for p in sidecars for x in open(p)]
    assert sorted(x["offset"] for x in lines) == sorted(r["offset"] for r in index)


def test_broken_streams_are_errors():
    whole = gzip.compress(W._record(1, b"x" * 5_000_000, None))
    assert len(list(W.records(W.StreamReader(io.BytesIO(whole))))) == 1
    two = gzip.compress(W._record(1, b"x", None)) + gzip.compress(W._record(2, b"", 1))
    assert len(list(W.records(W.StreamReader(io.BytesIO(two))))) == 2
    for cut in (10, len(whole) // 2, len(whole) - 9):
        with pytest.raises(EOFError):
            list(W.records(W.StreamReader(io.BytesIO(whole[:cut]))))
    assert list(W.records(W.StreamReader(io.BytesIO(b"")))) == []

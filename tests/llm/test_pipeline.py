import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as P
from __spark_entry__ import oracle_sql, queries
from dealscope.llm import secret_scan
from dealscope.llm.queries import PACK_TOKENIZER

from .test_host_rules import brute as measures
from .test_simhash import brute_components, brute_print
from .test_winnowing import brute as leaks

FOLDER = "/root/testdata/sf0.001"


def test_rows_equal_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    docs = [(i, t) for i, t in docs if not measures(t)[5]]
    roots = brute_components([brute_print(t) for _, t in docs])
    docs = [d for k, d in enumerate(docs) if roots[k] == k]
    found = leaks(docs, items)
    docs = [(i, t) for i, t in docs if not found[i][4]]
    docs = [(i, secret_scan.redacted(t, secret_scan.find_secrets(t))) for i, t in docs]
    tokenizer = Tokenizer.from_file(PACK_TOKENIZER)
    expected = set()
    for i, t in docs:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4").tobytes()
            expected.add((i, k, at, len(part) // 4, zlib.crc32(part)))
    rows = P.run(spark, FOLDER).collect()
    got = {(r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in rows}
    assert got == expected and len(rows) == len(expected)


def test_stages_keep_the_columns_and_names_are_registered(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    empty = docs.where("false")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, empty, FOLDER).columns == docs.columns
    names = set(queries())
    assert "pipeline" in names and set(oracle_sql()) <= names
    numbers = {int(m.group(1)) for n in names if (m := re.match(r"op(\d+)_", n))}
    assert numbers == set(range(1, 14))


def test_nulls_repeated_rows_long_texts_and_any_column_names(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 60")
    long = docs.where("doc_id = 3").selectExpr(
        "5000L doc_id", "repeat(concat(text, ' x '), 300) text", "lang", "source", "n_chars"
    )
    nulls = docs.limit(1).selectExpr(*[f"cast(null as {t}) {c}" for c, t in docs.dtypes])
    rows = docs.unionByName(docs.where("doc_id < 5")).unionByName(long).unionByName(nulls)
    rows = rows.selectExpr("*", "lang as `meta.lang`", "1 as n_words", "'x' as text_hash")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    for name, frame in (("some", rows), ("none", rows.where("false"))):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        benchmark.write.parquet(f"{folder}/benchmark.parquet")
    plain = str(tmp_path / "plain")
    docs.write.parquet(f"{plain}/documents.parquet")
    benchmark.write.parquet(f"{plain}/benchmark.parquet")
    expected = {r["doc_id"] for r in P.run(spark, plain).collect()}
    assert {r["doc_id"] for r in P.run(spark, str(tmp_path / "some")).collect()} - {5000} == expected
    assert P.run(spark, str(tmp_path / "none")).collect() == []

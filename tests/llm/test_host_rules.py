import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dealscope.llm import host_rules as H
from dealscope.llm.queries import op7_host_rules

from .rows import by_id, documents

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeated = Counter(), set()
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])] += 1
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            repeated.update(range(i, i + 8))
    lines, earlier = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in earlier
            earlier.add(line)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    chars = sum(map(len, words))
    return len(words), chars, len(re.findall("[#*$%&|<>]", text)), lines, len(repeated), failed


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " ", "\n", "\r\n", "\x85", " ", "#", "é", "a b c d e f g h\n"]), max_size=80).map("".join))
def test_measures_equal_brute_force(text):
    assert H.measure(text)[:6] == brute(text)


def test_small_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    out = by_id(op7_host_rules(spark, FOLDER))
    for d in docs:
        r = out[d["doc_id"]]
        got = [r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
        assert tuple(got) == brute(d["text"])
        assert r["kept"] == (not r["base_failed"])


def good(i):
    return " ".join(f"word{i}x{j}" for j in range(40))


def test_bad_host_takes_its_documents_along(spark):
    texts = [good(i) for i in range(60)] + ["bad"] * 57 + [good(i) for i in range(70, 73)]
    texts += ["bad", good(99)]
    sources = ["fine"] * 30 + ["other"] * 30 + ["rotten"] * 60 + ["tiny"] * 2
    docs = documents(spark, texts, sources)
    out = by_id(H.judge_documents(docs))
    assert all(out[i]["kept"] for i in range(60))
    assert not any(out[i]["kept"] for i in range(60, 120))
    assert out[121]["kept"]
    hosts = {r["host"]: r for r in H.host_verdicts(H.measure_documents(docs)).collect()}
    assert hosts["rotten"]["n_failed"] == 57 and hosts["rotten"]["rejected"]
    assert hosts["fine"]["shrunk_rate"] > 0 and 0 < hosts["tiny"]["shrunk_rate"] < 0.5
    kept = H.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 61


def test_prior_by_hand():
    hosts = [(10, 1), (20, 12), (40, 4), (5, 5)]
    n, f = sum(x for x, _ in hosts), sum(x for _, x in hosts)
    m, k = f / n, len(hosts)
    between = sum(x * (y / x - m) ** 2 for x, y in hosts)
    variance = (between - (k - 1) * m * (1 - m)) / (n - sum(x * x for x, _ in hosts) / n - (k - 1))
    strength = m * (1 - m) / variance - 1
    sums = (k, n, f, sum(x * x for x, _ in hosts), sum(y * y / x for x, y in hosts))
    assert H.beta_prior(*sums, 0.1) == pytest.approx((m * strength, (1 - m) * strength))
    assert H.beta_prior(0, None, None, None, None, 2.0) == (1.0, 1.0)
    assert H.beta_prior(1, 10, 10, 100.0, 10.0, 2.0) == (2.0, 0.0)


def test_edges(spark):
    docs = documents(spark, [None, "", good(1), good(1), good(2) * 20_000], [None, "a", None, "a", "a"])
    out = by_id(H.judge_documents(docs.withColumnRenamed("lang", "rejected_host")))
    assert [out[i]["kept"] for i in range(4)] == [False, False, True, True]
    assert H.judge_documents(docs.where("false")).count() == 0
    assert H.keep_good(docs.where("false")).count() == 0
    clash = docs.withColumnRenamed("lang", "kept")
    assert H.judge_documents(clash).columns.count("kept") == 1


def test_kept_documents_keep_columns_named_like_measures(spark):
    docs = documents(spark, [good(1), "bad", good(2)])
    names = ["n_words", "word_chars", "N_Symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "rule_failed", "kept", "input_kept"]
    extra = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS {n}" for n in names])
    out = H.keep_good(extra)
    assert out.columns == extra.columns
    rows = out.orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == [0, 2]
    assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)
    other = docs.selectExpr("doc_id", "text AS n_words", "source AS kept")
    assert sorted(r["doc_id"] for r in H.keep_good(other, "n_words", "kept").collect()) == [0, 2]

import random
import re

import numpy as np
import pytest

from dealscope.llm import bbit_minhash as M
from dealscope.llm.queries import op12_bbit_minhash

from .rows import by_id, documents

FOLDER = "/root/testdata/sf0.01"


def brute_set(text, size=4):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(texts):
    """(size of the set, smallest reachable index) of each text, by comparing all pairs."""
    sets = [brute_set(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if not x or not y or 10 * min(len(x), len(y)) < 8 * max(len(x), len(y)):
                continue
            if 100 * len(x & y) >= 80 * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(x), find(i)) for i, x in enumerate(sets)]


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(rng, base, n):
    made = list(base)
    for _ in range(n):
        made[rng.randrange(len(made))] = f"e{rng.randrange(10**6)}"
    return " ".join(made)


def check(spark, texts):
    got = by_id(M.cluster(documents(spark, texts)))
    want = brute(texts)
    assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == want


def test_given_documents_equal_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    got = by_id(op12_bbit_minhash(spark, FOLDER))
    for (i, _), (size, root) in zip(docs, brute([t for _, t in docs]), strict=True):
        row = got[i]
        assert (row["n_shingles"], row["component_id"]) == (size, docs[root][0])
        assert row["kept"] == (i == docs[root][0])


def test_large_groups_of_near_copies_and_of_templates_lose_no_link(spark):
    rng = random.Random(3)
    base, other = words(rng, 240), words(rng, 200)
    texts = [edited(rng, base, rng.randrange(1, 12)) for _ in range(90)]
    texts += [" ".join(other[:150]) + f" x{k} " + " ".join(words(rng, 30)) for k in range(60)]
    texts += [texts[0]] * 30 + [" ".join(words(rng, 60)) for _ in range(20)]
    rng.shuffle(texts)
    check(spark, texts)


def test_block_pairs_find_every_pair_of_different_groups(spark, monkeypatch):
    monkeypatch.setattr(M, "_BLOCK", 4)
    rng = random.Random(5)
    base = words(rng, 100)
    texts = [edited(rng, base, 1) for _ in range(23)]
    sets = M.minhash_sets(documents(spark, texts))
    nodes = sets.selectExpr("doc_id node", "n_shingles", "signature", "bands", "parity")
    named = M.bucket_members(nodes).selectExpr("bucket", "node", "least(node, 5) root")
    pairs = {tuple(r) for r in M.block_pairs(named, nodes).collect()}
    assert pairs == {(i, j) for j in range(6, 23) for i in range(5)} | {
        (i, 5) for i in range(5)
    } | {(i, j) for i in range(5) for j in range(i + 1, 5)}


def test_small_sets_nulls_ties_and_repeated_rows(spark):
    texts = [None, "", " \n", "a", "A", "a b", "a b c d", "A b C d", "a b c d e", "é " * 9]
    check(spark, texts)
    rows = documents(spark, ["a b c d e"]).union(documents(spark, ["a b c d e"]))
    rows = rows.union(documents(spark, ["q r s t u v"]))
    nameless = rows.selectExpr("cast(null as long) doc_id", "text", "1 as key", "'x' as `ba.nds`")
    assert M.cluster(rows).count() == 3
    assert [r["component_id"] for r in M.cluster(nameless).collect()] == [None] * 3
    assert M.cluster(rows.where("false")).collect() == []


def test_very_long_text(spark):
    rng = random.Random(8)
    base = words(rng, 150_000)
    got = by_id(M.cluster(documents(spark, [" ".join(base), edited(rng, base, 200), "x y"])))
    assert [got[i]["component_id"] for i in range(3)] == [0, 0, 2]


@pytest.mark.parametrize("similarity", [0.8, 0.5])
def test_estimate_is_corrected_and_the_threshold_far_below(similarity):
    rng = np.random.default_rng(1)
    seen = []
    for _ in range(60):
        n = 900
        common = round(2 * n * similarity / (1 + similarity))
        ids = rng.integers(0, 1 << 63, 2 * n - common, np.uint64)
        least = np.stack([M.minima(ids[:n]), M.minima(ids[n - common :])])
        a, b = M.signatures(least)
        seen.append(int(M._differing(a, b)))
    assert abs(np.mean([M.estimate(x) for x in seen]) - similarity) < 0.02
    if similarity == 0.8:
        assert max(seen) < M.most_differing()


def test_bitmaps_never_reject_similar_sets_and_reject_others():
    rng = np.random.default_rng(9)
    rejected = 0
    for _ in range(300):
        n = int(rng.integers(1, 1500))
        m = int(rng.integers(0, n + 1))
        ids = rng.integers(0, 1 << 63, n + 400, np.uint64)
        a, b = set(ids[:n].tolist()), set(ids[m // 4 : n + m // 8].tolist())
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        apart = M.too_different(M.parity_map(x), M.parity_map(y), len(a) + len(b))
        similar = 100 * len(a & b) >= 80 * len(a | b)
        assert not (apart and similar)
        if 100 * len(a & b) < 74 * len(a | b) and n > 100:
            rejected += apart
            assert apart
    assert rejected > 10

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from dealscope.llm import simhash as H
from dealscope.llm.queries import op10_simhash

from .rows import by_id, documents

FOLDER = "/root/testdata/sf0.01"


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    runs = [words[i : i + 4] for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    """Root of each index, by comparing all pairs."""
    values = np.array(prints, np.uint64)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_table_equals_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    prints = [brute_print(t) for _, t in docs]
    roots = brute_components(prints)
    out = by_id(op10_simhash(spark, FOLDER))
    assert len(out) == len(docs)
    for (i, _), value, root in zip(docs, prints, roots, strict=True):
        assert out[i]["fingerprint"] == f"{value:016x}"
        assert out[i]["component_id"] == docs[root][0]
    assert len(set(roots)) < len(set(prints))


def labels(spark, prints, radius=4):
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print long")
    edges = H.links(frame, radius).collect()
    index = {int(np.uint64(p).view(np.int64)): i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in edges:
        i, j = index[r["a"]], index[r["b"]]
        assert int(prints[i] ^ prints[j]).bit_count() <= radius and r["a"] < r["b"]
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(len(prints))], len(edges)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_connect_like_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    # Correlated bits: half of the values share their upper half.
    base[:75] = (base[:75] & np.uint64(0xFFFFFFFF)) | np.uint64(0xABCD << 40)
    values = set(base.tolist())
    for x in base[:100].tolist():
        for _ in range(6):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            values.add(x ^ sum(1 << int(f) for f in flips))
    prints = sorted(values)
    found, _ = labels(spark, prints)
    assert found == brute_components(prints)


def test_large_group_gives_a_linear_number_of_links(spark):
    rng = np.random.default_rng(7)
    center = int(rng.integers(0, 1 << 63))
    values = {center}
    while len(values) < 1500:
        values.add(center ^ sum(1 << int(f) for f in rng.choice(64, 2, replace=False)))
    prints = sorted(values)
    found, edges = labels(spark, prints)
    assert set(found) == {0} and edges < 150 * len(prints)


@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**12])
def test_thresholds_cover_the_radius(n):
    rng = np.random.default_rng(1)
    bits = rng.random((1000, 64)) < rng.uniform(0.2, 0.8, 64)
    both = bits.T.astype(float) @ bits / 1000 * n
    plan = H.allocate(n, both)
    assert sum(t + 1 for _, t in plan) == 5
    used = [b for part, _ in plan for b in part]
    assert len(used) == len(set(used))


def test_parts_hold_correlated_bits_together():
    rng = np.random.default_rng(2)
    bits = rng.random((4000, 64)) < 0.5
    bits[:, 1] = bits[:, 0]
    bits[:, 40] = bits[:, 0]
    both = bits.T.astype(float) @ bits
    (part,) = [p for p in H.correlated_parts(4000, both, 4) if 0 in p]
    assert {1, 40} <= set(part)


def test_long_chains_become_one_component(spark):
    edges = [(i, i + 1) for i in range(1, 300)] + [(1000, 1001), (5, 5)]
    rows = H.components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(got) == 302
    assert all(got[i] == 1 for i in range(1, 301)) and got[1001] == got[1000] == 1000


def text(i):
    return " ".join(f"w{i}x{j}" for j in range(30))


def test_edges(spark):
    texts = [None, "", " \n", "one two", "one two", text(1), text(1).upper(), "long " * 60_000]
    docs = documents(spark, texts).withColumnRenamed("lang", "component_id")
    rows = H.cluster(docs).collect()
    got = {r["doc_id"]: r["component_id"] for r in rows}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7}
    assert H.cluster(docs.where("false")).count() == 0


def test_one_document_of_each_group_stays(spark):
    texts = [text(1), text(2), text(1), text(3), text(2), "x"]
    docs = documents(spark, texts)
    nameless = docs.where("doc_id in (3, 5)").selectExpr("cast(null as long) doc_id", "'only one ' || text text", "lang", "source", "n_chars")
    rows = docs.unionByName(docs.where("doc_id = 0")).unionByName(nameless).unionByName(nameless)
    out = H.drop_near_copies(rows)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 3, 5]
    groups = defaultdict(int)
    for r in out.collect():
        groups[r["text"]] += 1
    assert set(groups.values()) == {1}
    assert H.drop_near_copies(docs.where("false")).count() == 0


def test_stage_keeps_the_smallest_document_of_each_component(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    roots = brute_components([brute_print(t) for _, t in rows])
    kept = sorted(r["doc_id"] for r in H.drop_near_copies(docs).collect())
    assert kept == [rows[k][0] for k, r in enumerate(roots) if r == k]


def test_stage_passes_columns_of_any_name(spark):
    docs = documents(spark, [text(1), text(1), text(2)])
    docs = docs.selectExpr("*", "lang as `meta.lang`", "source as print", "lang as component_id")
    out = H.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2]

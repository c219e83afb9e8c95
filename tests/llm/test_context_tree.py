import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from dealscope.llm import context_tree as C
from dealscope.llm.queries import op6_context_tree

from .rows import by_id, documents

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return (text or "").encode().lower()


def is_held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute_base(rows):
    counts = Counter()
    for i, text in rows:
        if not is_held_out(i):
            counts.update([*lower(text).split(), None])
    n, v = counts.total(), len(counts)
    out = {}
    for i, text in rows:
        tokens = [*lower(text).split(), None]
        score = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        out[i] = (len(tokens), sum(counts[t] > 0 for t in tokens), n, score)
    return out


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class BruteTree:
    """Context-tree weighting from its definition, on dictionaries."""

    def __init__(self, texts, depth, least):
        self.depth = depth
        seen = []
        for t in texts:
            s = bytes([C.END]) * depth + t + bytes([C.END])
            seen += [(s[i - depth : i][::-1], s[i]) for i in range(depth, len(s))]
        count = Counter(c[:d] for c, _ in seen for d in range(depth + 1))
        self.kept = {c for c, n in count.items() if n >= least} | {b""}
        self.bits = defaultdict(lambda: [0, 0])
        for context, symbol in seen:
            for node in self.path(context):
                for k in range(8):
                    self.bits[node, k, symbol >> (8 - k)][symbol >> (7 - k) & 1] += 1
        self.memo = {}

    def path(self, context):
        """Nodes of the tree on the way of a context; the last may be a rest leaf."""
        nodes = []
        for d in range(self.depth + 1):
            if context[:d] not in self.kept:
                return [*nodes, ("rest", nodes[-1])]
            nodes.append(context[:d])
        return nodes

    def children(self, node):
        if isinstance(node, tuple) or len(node) == self.depth:
            return []
        found = [c for c in self.kept if len(c) == len(node) + 1 and c[:-1] == node]
        return [*found, ("rest", node)] if found else []

    def weighted(self, node, k, v):
        key = (node, k, v)
        if key not in self.memo:
            own = log_kt(*self.bits[node, k, v])
            below = [self.weighted(c, k, v) for c in self.children(node)]
            if below:
                own = np.logaddexp(own, sum(below)) - math.log(2)
            self.memo[key] = own
        return self.memo[key]

    def one(self, path, k, v):
        node = path[0]
        a, b = self.bits[node, k, v]
        own = (b + 0.5) / (a + b + 1)
        if len(path) == 1 or not self.children(node):
            return own
        weight = math.exp(log_kt(a, b) - self.weighted(node, k, v)) / 2
        return weight * own + (1 - weight) * self.one(path[1:], k, v)

    def score(self, text):
        s = bytes([C.END]) * self.depth + text + bytes([C.END])
        total = 0.0
        for i in range(self.depth, len(s)):
            path = self.path(s[i - self.depth : i][::-1])
            if len(path) > 1 and not self.children(path[-2]):
                path = path[:-1]
            for k in range(8):
                p = self.one(path, k, s[i] >> (8 - k))
                total += math.log10(p if s[i] >> (7 - k) & 1 else 1 - p)
        return total


@pytest.mark.parametrize("depth", [2, 4])
def test_scores_equal_the_definition(spark, monkeypatch, depth):
    monkeypatch.setattr(C, "_CHUNK_GRAMS", 10)
    monkeypatch.setattr(C, "WORD_SHARE", 4)
    texts = ["abracadabra", "abra cad É", None, "", "the cat sat on the mat", "abracadabra", "zz"]
    texts += [f"the {w} sat {i}" for i, w in enumerate(["dog", "cat", "Hat"] * 5)]
    rows = list(enumerate(texts))
    tree = BruteTree([lower(t) for i, t in rows if not is_held_out(i)], depth, C.LEAST)
    out = by_id(C.score_documents(documents(spark, texts), depth=depth))
    base = brute_base(rows)
    assert len(out) == len(rows) and {r["held_out"] for r in out.values()} == {True, False}
    for i, text in rows:
        r = out[i]
        assert r["held_out"] == is_held_out(i)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == base[i][:3]
        assert r["base_score"] == pytest.approx(base[i][3], rel=1e-9)
        assert r["score"] == pytest.approx(tree.score(lower(text)), rel=1e-5)


def test_predictions_sum_to_one_and_slices_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"ab c"), n).tolist()) for n in (0, 1, 500, 3000, 7)]
    joined = C.join_texts(texts, 3)
    assert joined.coded.sum() == sum(map(len, texts)) + len(texts)

    codes, counts = C._merged(list(C.count_grams(joined, 3)))
    every = np.unique((codes & ~np.uint64(255))[:, None] | np.arange(256, dtype=np.uint64))
    counts = dict(zip(codes.tolist(), counts.tolist(), strict=True))
    counts = np.array([counts.get(c, 0) for c in every.tolist()])
    roots = C.forest(every, counts, 2, 3)[0]
    outer = {}
    for c, table, mixed in zip(roots.contexts.tolist(), roots.table, roots.mixed, strict=True):
        outer[c & 255] = outer.get(c & 255, 0) + np.concatenate([table, mixed])
    logs = C.subtree_logs(every, counts, C.build_top(every, counts, 1, outer), 3)
    assert np.allclose((10 ** logs.reshape(-1, 256)).sum(axis=1), 1, atol=1e-5)
    first = C.score_texts(texts, every, logs, 3)
    monkeypatch.setattr(C, "_SLICE", 97)
    assert np.allclose(C.score_texts(texts, every, logs, 3), first)
    assert np.allclose([C.score_texts([t], every, logs, 3)[0] for t in texts], first)


def test_blocks_do_not_matter_and_the_model_grows(spark, monkeypatch):
    texts = [f"word{i % 7} other{i % 5} {'ab' * (i % 9)}" for i in range(60)]
    docs = documents(spark, texts)
    first = by_id(C.score_documents(docs))
    sizes = []
    for n in (20, 60):
        blocks = C._blocks(docs.where(f"doc_id < {n}"), "doc_id", "text")
        grams = C._partials(blocks, 5).where("gram is not null").groupBy("gram").agg(C.F.sum("n").alias("n"))
        sizes.append(grams.count())
        assert C.fit(grams, 5).count() == sizes[-1]
    assert sizes[0] < sizes[1]
    monkeypatch.setattr(C, "_BLOCK_BYTES", 64)
    again = by_id(C.score_documents(docs.coalesce(1)))
    for i, r in first.items():
        assert again[i]["score"] == pytest.approx(r["score"], rel=1e-6)


def test_small_table_and_held_out_gain(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = by_id(op6_context_tree(spark, FOLDER))
    base = brute_base(rows)
    for i, _ in rows:
        assert (out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"]) == base[i][:3]
        assert out[i]["base_score"] == pytest.approx(base[i][3], rel=1e-9)
    held = [r["code_length"] for r in out.values() if r["held_out"]]
    assert sum(held) / len(held) < 3


def test_edges(spark):
    docs = documents(spark, ["a", "a", None, "x" * 3_000_000])
    rows = docs.unionByName(docs.where("doc_id = 1")).withColumnRenamed("lang", "score")
    out = C.score_documents(rows)
    assert out.count() == 5
    assert C.score_documents(docs.where("false")).count() == 0
    only = docs.where("doc_id is null").unionByName(docs.selectExpr("null doc_id", "text", "lang", "source", "n_chars"))
    assert C.score_documents(only).where("not held_out").count() == 4
    i = next(i for i in range(100) if is_held_out(i))
    alone = docs.where("doc_id = 0").selectExpr(f"{i} doc_id", "text")
    r = C.score_documents(alone).first()
    assert r["score"] == pytest.approx(-16 * math.log10(2), rel=1e-6)
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (2, 0, 0, 0)

import hashlib
import random
import re

import pytest

from dealscope.llm import winnowing as N
from dealscope.llm.queries import op5_decontamination

from .rows import by_id, documents

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLDER = "/root/testdata/sf0.001"


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(texts, items, window=10):
    parts = [(str(i), words(t)) for i, t in items]
    spans = {}
    for item, w in parts:
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            spans.setdefault(tuple(w[a : a + n]), set()).add(item)
    sizes = {len(s) for s in spans}
    out = {}
    for i, text in texts:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                got = spans.get(tuple(w[a : a + n]))
                if got:
                    hit.update(range(a, a + n))
                    found |= got
        listed = ",".join(sorted(found))
        digest = hashlib.sha256(listed.encode()).hexdigest()
        out[i] = (len(w), len(hit), len(found), digest, bool(hit))
    return out


def compare(found, expected):
    rows = by_id(found)
    assert len(rows) == len(expected)
    for i, want in expected.items():
        r = rows[i]
        got = (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
        assert got == want, i


@pytest.fixture
def short_segments(monkeypatch):
    monkeypatch.setattr(N, "_SEGMENT", 7)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_small_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    expected = brute(docs, items)
    assert any(x[4] for x in expected.values())
    compare(op5_decontamination(spark, FOLDER), expected)


def test_random_texts_with_repeats_and_short_items(spark, short_segments):
    rng = random.Random(5)
    alphabet = ["a", "b", "É", "c9"]

    def text(n):
        return " ".join(rng.choice(alphabet) for _ in range(n))

    items = [(i, text(rng.choice([0, 2, 5, 9, 10, 11, 25]))) for i in range(25)]
    items += [(30, items[3][1]), (31, None), (32, "...")]
    texts = [text(rng.randrange(60)) for _ in range(60)]
    texts += [None, "", "!!", " ".join(["a"] * 200), items[4][1], "b-B!" * 20]
    texts += [f"x {t or ''} y" for _, t in items]
    expected = brute(list(enumerate(texts)), items)
    compare(N.mark_contaminated(documents(spark, texts), items_frame(spark, items)), expected)


def test_every_shared_span_is_found_at_any_place(spark, short_segments):
    item = " ".join(f"w{i}" for i in range(30))
    texts = [
        " ".join([f"x{j}" for j in range(before)] + item.split()[a : a + n] + ["tail"] * 3)
        for before in (0, 1, 5, 6, 7, 8, 20)
        for a in (0, 3, 20)
        for n in (9, 10)
    ]
    expected = brute(list(enumerate(texts)), [(1, item)])
    assert sum(x[4] for x in expected.values()) == len(texts) // 2
    compare(N.mark_contaminated(documents(spark, texts), items_frame(spark, [(1, item)])), expected)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 3)
    item = " ".join(f"w{i}" for i in range(40))
    texts = [item, item[:60], "nothing", f"{item} {item}"]
    compare(
        N.mark_contaminated(documents(spark, texts), items_frame(spark, [(1, item), (2, item)])),
        brute(list(enumerate(texts)), [(1, item), (2, item)]),
    )


def test_edges(spark):
    item = " ".join(f"w{i}" for i in range(12))
    items = items_frame(spark, [(1, item)])
    docs = documents(spark, [None, "", item, item, "ok", "w " * 30_000 + item])
    rows = docs.unionByName(docs.where("doc_id = 2")).withColumnRenamed("lang", "key")
    out = N.mark_contaminated(rows, items)
    assert out.count() == 7 and out.where("contaminated").count() == 4
    assert N.mark_contaminated(docs.where("false"), items).count() == 0
    assert N.mark_contaminated(docs, items.where("false")).where("contaminated").count() == 0
    kept = N.drop_contaminated(rows, items)
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 4]


def test_no_python_in_the_plan(spark):
    plan = op5_decontamination(spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

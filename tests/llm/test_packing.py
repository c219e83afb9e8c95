import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dealscope.llm import packing as P
from dealscope.llm.queries import PACK_TOKENIZER, op4_best_fit_packing

from .rows import documents

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PACK_TOKENIZER)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85\xa0 　'sStT<|endoftext|>aÉ́ß9-!ΣİA가"),
    st.characters(exclude_categories=("Cs",)),
)))
def test_cached_words_give_the_tokenizers_ids(text):
    cache = test_cached_words_give_the_tokenizers_ids.__dict__.setdefault(
        "cache", P.WordCache(PACK_TOKENIZER)
    )
    whole = cache.tokenizer.encode(text, add_special_tokens=False).ids
    for part in (text, text, text + "."):
        (ids,) = cache.encode_all([part.encode()])
        want = cache.tokenizer.encode(part, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
    several = cache.encode_all([text.encode(), b"", text.upper().encode()])
    assert np.frombuffer(several[0], "<u4").tolist() == whole and several[1] == b""


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_is_a_packing_and_as_good_as_the_plain_rule(sizes):
    bins = P.best_fit(sizes, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 20 for b in bins)
    rooms = []
    for size in sorted(sizes, reverse=True):
        fitting = [r for r in rooms if r >= size]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - size)
        else:
            rooms.append(20 - size)
    assert len(bins) == len(rooms)


def expected_pieces(tokenizer, texts, capacity):
    made = {}
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            made[i, k] = (at, len(part), zlib.crc32(part.tobytes()))
    return made


def check(rows, expected, capacity):
    assert len(rows) == len(expected)
    bins = defaultdict(list)
    for r in rows:
        crc = zlib.crc32(bytes(r["ids"]))
        assert (r["start"], r["length"], crc) == expected[r["doc_id"], r["piece"]]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_documents_of_the_small_table(spark, tokenizer):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    expected = expected_pieces(tokenizer, texts, P.CAPACITY)
    count = check(P.pack(docs, PACK_TOKENIZER).collect(), expected, P.CAPACITY)
    tokens = sum(length for _, length, _ in expected.values())
    assert count <= 1.03 * -(-tokens // P.CAPACITY) + 1
    rows = op4_best_fit_packing(spark, FOLDER).collect()
    assert {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in rows} == {
        k: v[2] for k, v in expected.items()
    }


def test_rounds_join_the_rests_of_many_tasks(spark, tokenizer):
    texts = ["word " * (1 + i * 7 % 50) for i in range(400)]
    docs = documents(spark, texts).repartition(40)
    expected = expected_pieces(tokenizer, texts, 64)
    rows = P.pack(docs, PACK_TOKENIZER, capacity=64, items_per_task=30).collect()
    joined = check(rows, expected, 64)
    assert joined <= 1.05 * sum(n for _, n, _ in expected.values()) / 64


def test_edges(spark, tokenizer):
    texts = [None, "", "a", "a", "long " * 50_000, "é\n"]
    docs = documents(spark, texts).withColumnRenamed("lang", "sequence_id")
    docs = docs.withColumnRenamed("source", "length")
    rows = P.pack(docs, PACK_TOKENIZER).collect()
    check(rows, expected_pieces(tokenizer, texts, P.CAPACITY), P.CAPACITY)
    assert P.pack(docs.where("false"), PACK_TOKENIZER).count() == 0

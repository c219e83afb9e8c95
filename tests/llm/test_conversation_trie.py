import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from dealscope.llm import conversation_trie as C
from dealscope.llm.queries import op13_conversation_trie

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(sequences):
    """Nodes of {conv_id: [(role, text), ...]}, each prefix with all that start with it."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(sequences):
        path = tuple(sequences[conv])
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
        ends[path].append(conv)
    rows = set()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        parents = {n[:-1] for n in members if n}
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        rows.add(
            (
                convs[0],
                len(node),
                members[node[:-1]][0] if node else None,
                len(convs),
                sum(1 for n in members if n and n[:-1] == node),
                sum(n not in parents for n in below),
                saved,
                hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
            )
        )
    return rows


def rows_of(df):
    return [tuple(r) for r in df.select(*C.COLUMNS).collect()]


def frame(spark, sequences):
    rows = [(c, t, *said) for c, turns in sequences.items() for t, said in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("per_shard", [3, 40, 10**6])
def test_nodes_equal_brute_force_whatever_the_shards(spark, per_shard):
    rng = random.Random(per_shard)
    said = [(r, t) for r in ("user", "assistant") for t in ("", "ä", "yes", "no " * 9)]
    seqs = {c: [rng.choice(said[:3]) for _ in range(rng.randrange(1, 9))] for c in range(60)}
    seqs |= {c: [said[1]] * 5 for c in range(100, 140)}  # many copies of one conversation
    seqs |= {c: [said[1]] * 5 + [said[c % 8]] for c in range(140, 170)}
    seqs[500] = [said[k % 8] for k in range(700)]
    digests = C.turn_digests(frame(spark, seqs))
    got = rows_of(C.trie_nodes(digests, turns_per_shard=per_shard))
    assert len(got) == len(set(got)) and set(got) == brute(seqs)


def test_rebuilt_conversations_equal_brute_force(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    own = {c: [x[1:] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + said[h:]
    got = rows_of(op13_conversation_trie(spark, FOLDER))
    assert len(got) == len(set(got)) and set(got) == brute(rebuilt)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [
        (1, None, None, None, "x", "y"),
        (1, 0, "user", "a", "x", "y"),
        (1, 0, "user", "a", "x", "y"),
        (2, None, "", "", "x", "y"),
        (2, 0, "user", "a", "x", "y"),
        (None, 0, "user", "a", "x", "y"),
        (3, 5, "user", "b" * 3_000_000, "x", "y"),
    ]
    df = spark.createDataFrame(rows, SCHEMA + ", depth string, `dig.est` string")
    expected = brute(
        {1: [("", ""), ("user", "a"), ("user", "a")], 2: [("", ""), ("user", "a")],
         3: [("user", "b" * 3_000_000)]}
    )
    assert set(rows_of(C.prefix_trie(df))) == expected
    assert rows_of(C.prefix_trie(df.where("false"))) == []


def test_conversations_without_turns_are_members_of_the_root(spark):
    rows = [(4, -1, None, 0), (7, -1, None, 0), (7, 0, bytes(16), 3)]
    digests = spark.createDataFrame(rows, "conv_id long, turn long, digest binary, size long")
    got = {r["depth"]: r for r in C.trie_nodes(digests).collect()}
    assert got[0]["n_convs"] == 2 and got[0]["n_leaves"] == 1
    assert got[0]["ends_sha256"] == hashlib.sha256(b"4").hexdigest()
    only = C.trie_nodes(digests.where("conv_id = 4")).collect()
    assert [tuple(r)[:7] for r in only] == [(4, 0, None, 1, 0, 1, 0)]


def test_double_array_keeps_children_of_far_apart_codes_without_waste():
    array = C.DoubleArray()
    rng = np.random.default_rng(0)
    at = np.zeros(1, np.int64)
    added = 1
    for _ in range(4):
        children = [np.sort(rng.choice(30_000, 2, replace=False)) + 1 for _ in at]
        codes = np.concatenate(children)
        slots = array.add_level(np.repeat(at, 2), codes)
        assert len(set(slots.tolist())) == len(slots)
        assert (array.step(np.repeat(at, 2), codes) == slots).all()
        at, added = slots, added + len(slots)
    assert (array.check[: array.top] >= 0).sum() == added
    with pytest.raises(ValueError):
        array.step(at[:1], np.array([3]))

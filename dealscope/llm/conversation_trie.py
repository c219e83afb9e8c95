"""Prefix trie of conversations, as double arrays over dense turn ids.

A turn is told by a 128-bit digest of role and text, and a conversation is the sequence of
its turns' digests. Sequences are range-partitioned in prefix order, so every shard holds a
contiguous range of prefixes, whatever prefix is common: conversations that are all alike are
dealt by their ids. In a shard the turns get dense ids and the sequences are packed into BASE
and CHECK arrays; the child of node s by turn c is BASE[s] + c, if CHECK of that is s. All
sequences are then walked through the arrays together, level by level, to sum up the nodes.

Only the upper nodes on the path of a shard's first or last sequence can have members in
other shards. How many of them do is known from the two neighbouring sequences; such nodes
are emitted as partial sums under a digest of their prefix and merged by a ``groupBy``. A node
counts as new in the first shard that has it, and as childless in the last one only, so that
all sums are additive.

Defined results: rows without conv_id belong to no conversation; null role or text is empty; a
null turn comes first; equal turns are ordered by the digest; repeated rows are turns of
their own; very long texts count by their digests; a conversation's digests, 24 bytes a turn,
are held by one task; an empty table has no nodes, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, small_or_shuffled, written

_WIDTH = 16  # bytes of a digest
_ROWS = 4096  # sequences of an Arrow batch
TURNS_PER_SHARD = 4_000_000
IDS_PER_PIECE = 4096
NO_IDS = hashlib.sha256(b"").hexdigest()

_NODE = (
    "kind int, key binary, parent_key binary, shard int, piece int, depth long, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, ids string"
)
_WHOLE, _PART, _IDS = range(3)
COLUMNS = [
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
]


def turn_digests(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turn, digest, size): 16 bytes for role and text, and the text's bytes."""
    said = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    who = F.coalesce(F.col(f"`{role}`"), F.lit(""))
    named = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    return turns.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.md5(named)).alias("digest"),
        F.octet_length(said).cast("long").alias("size"),
    )


def sequences(digests: DataFrame) -> DataFrame:
    """(conv_id, turns, sizes, n_turns): packed digests and text sizes of each conversation.

    A row whose digest is null makes a conversation without adding a turn to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, sizes = None, [], []
        done: list[tuple] = []

        def finish() -> None:
            if now is not None:
                made = b"".join(turns)
                done.append((now, made, b"".join(sizes), len(made) // _WIDTH))

        def batch_of() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["conv_id", "turns", "sizes", "n_turns"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            there = np.asarray(batch.column(1).is_valid())
            data = b"".join(x for x in batch.column(1).to_pylist() if x)
            texts = batch.column(2).to_numpy()[there].astype("<i8").tobytes()
            at = np.r_[0, np.cumsum(there)]
            edges = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1], True])
            firsts, cuts = ids[edges[:-1]].tolist(), at[edges].tolist()
            for conv, low, high in zip(firsts, cuts, cuts[1:]):
                if conv != now:
                    finish()
                    now, turns, sizes = conv, [], []
                turns.append(data[_WIDTH * low : _WIDTH * high])
                sizes.append(texts[8 * low : 8 * high])
            if len(done) >= _ROWS:
                yield batch_of()
                done.clear()
        finish()
        if done:
            yield batch_of()

    ordered = digests.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "digest"
    )
    return ordered.select("conv_id", "digest", "size").mapInArrow(
        run, "conv_id long, turns binary, sizes binary, n_turns long"
    )


class DoubleArray:
    """BASE and CHECK of a trie; the root is state 0."""

    _NEAR = 1 << 16  # slots before the end that are searched for room

    def __init__(self):
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0] = 0
        self.top = 1  # all slots from here on are free

    def _reach(self, slots: int) -> None:
        while len(self.check) < slots:
            self.base = np.r_[self.base, np.zeros_like(self.base)]
            self.check = np.r_[self.check, np.full_like(self.check, -1)]

    def _room(self, offsets: np.ndarray) -> int:
        """First slot near the end such that it and those at the offsets are free."""
        if offsets[-1] < 2 * len(offsets):
            return self.top  # codes of new turns follow each other: no gaps worth filling
        low = max(1, self.top - self._NEAR)
        self._reach(self.top + int(offsets[-1]) + 1)
        free = low + np.flatnonzero(self.check[low : self.top] < 0)
        for offset in offsets[1:].tolist():
            free = free[self.check[free + offset] < 0]
        return int(free[0]) if len(free) else self.top

    def add_level(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots of the children of states, given in runs of equal parents."""
        edges = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1], True])
        counts = np.diff(edges)
        slots = np.empty(len(codes), np.int64)
        for k in np.flatnonzero(counts > 1).tolist():
            some = codes[edges[k] : edges[k + 1]]
            least = some.min()
            first = self._room(np.sort(some - least))
            self._reach(first + int((some - least).max()) + 1)
            slots[edges[k] : edges[k + 1]] = made = first + some - least
            self.base[parents[edges[k]]] = first - least
            self.check[made] = parents[edges[k]]
            self.top = max(self.top, int(made.max()) + 1)
        single = edges[:-1][counts == 1]
        low = max(1, self.top - self._NEAR)
        gaps = low + np.flatnonzero(self.check[low : self.top] < 0)[: len(single)]
        more = len(single) - len(gaps)
        made = np.r_[gaps, self.top + np.arange(more)]
        self._reach(self.top + more)
        self.top += more
        slots[single] = made
        self.base[parents[single]] = made - codes[single]
        self.check[made] = parents[single]
        return slots

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each state by its code; all of them have to be there."""
        to = self.base[states] + codes
        if not (self.check[to] == states).all():
            raise ValueError("a sequence is not in the trie")
        return to


def dense_codes(high: np.ndarray, low: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the distinct digests, in the order of depth and first appearance."""
    if not len(high):
        return np.empty(0, np.int64)
    order = np.lexsort((np.arange(len(high)), depth, low, high))
    new = np.r_[True, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])]
    first = order[new]
    rank = np.empty(len(first), np.int64)
    rank[np.lexsort((first, depth[first]))] = np.arange(1, len(first) + 1)
    codes = np.empty(len(high), np.int64)
    codes[order] = rank[np.cumsum(new) - 1]
    return codes


class Shard:
    """The trie of one range of sequences, sorted by turns and conversation."""

    def __init__(self, conv_ids: np.ndarray, turns: list[bytes], sizes: list[bytes]):
        new = [True, *(a != b for a, b in zip(turns, turns[1:], strict=False))]
        first = np.flatnonzero(new)
        self.conv_ids = conv_ids
        self.row_ends = np.r_[first[1:], len(turns)]
        self.rows = self.row_ends - first
        self.least = conv_ids[first]
        self.turns = [turns[k] for k in first.tolist()]
        self.lengths = np.array([len(t) for t in self.turns], np.int64) // _WIDTH
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.sizes = np.frombuffer(b"".join(sizes[k] for k in first.tolist()), "<i8")
        depth = np.arange(len(self.sizes)) - np.repeat(self.starts, self.lengths)
        digest = np.frombuffer(b"".join(self.turns), "<u8").reshape(-1, 2)
        self.codes = dense_codes(digest[:, 0], digest[:, 1], depth)
        self.array = DoubleArray()
        self._pack()
        self._walk()

    def _active(self) -> Iterator[tuple[int, np.ndarray]]:
        """Sequences that go on beyond each depth."""
        active = np.arange(len(self.lengths))
        for depth in range(int(self.lengths.max(initial=0))):
            active = active[self.lengths[active] > depth]
            yield depth, active

    def _pack(self) -> None:
        at = np.zeros(len(self.lengths), np.int64)
        for depth, active in self._active():
            states, codes = at[active], self.codes[self.starts[active] + depth]
            new = np.r_[True, (states[1:] != states[:-1]) | (codes[1:] != codes[:-1])]
            slots = self.array.add_level(states[new], codes[new])
            at[active] = slots[np.cumsum(new) - 1]

    def _walk(self) -> None:
        """Sums of each state over its members, by following all sequences."""
        n = self.array.top
        self.n_convs, self.below, self.size, self.depth = np.zeros((4, n), np.int64)
        self.conv = np.full(n, np.iinfo(np.int64).max)
        total = np.add.reduceat(np.r_[self.sizes, 0], self.starts) * (self.lengths > 0)
        self.n_convs[0], self.conv[0] = self.rows.sum(), self.least.min()
        self.below[0] = (total * self.rows).sum()
        self.levels = [np.zeros(1, np.int64)]
        left = total.copy()
        at = np.zeros(len(self.lengths), np.int64)
        self.paths = {0: [0], len(self.lengths) - 1: [0]}  # of the first and last sequence
        for depth, active in self._active():
            place = self.starts[active] + depth
            to = at[active] = self.array.step(at[active], self.codes[place])
            new = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            states = to[new]
            self.n_convs[states] = np.add.reduceat(self.rows[active], new)
            self.conv[states] = np.minimum.reduceat(self.least[active], new)
            self.below[states] = np.add.reduceat(left[active] * self.rows[active], new)
            self.size[states] = self.sizes[place[new]]
            self.depth[states] = depth + 1
            left[active] -= self.sizes[place]
            self.levels.append(states)
            for row, path in self.paths.items():
                if self.lengths[row] > depth:
                    path.append(int(at[row]))
        self.ends = at

    def nodes(self, before: int, after: int) -> tuple[np.ndarray, ...]:
        """(states, shared, children, leaves, saved): sums that add up over shards.

        ``before`` and ``after`` are how many turns the first and the last sequence share with
        their neighbours in other shards; -1 if there is none.
        """
        n = self.array.top
        new, goes_on = np.ones(n, bool), np.zeros(n, bool)
        new[self.paths[0][: before + 1]] = False
        goes_on[self.paths[len(self.lengths) - 1][: after + 1]] = True
        children, any_child = np.zeros((2, n), np.int64)
        states = np.concatenate(self.levels)
        parents = self.array.check[states[1:]]
        np.add.at(children, parents, new[states[1:]].astype(np.int64))
        any_child[parents] = 1
        leaves = ((any_child == 0) & ~goes_on).astype(np.int64)
        own = np.where(new, self.size, 0)
        for level in reversed(self.levels[1:]):
            up = self.array.check[level]
            np.add.at(leaves, up, leaves[level])
            np.add.at(own, up, own[level])
        return states, ~new | goes_on, children, leaves, self.below - own

    def keys(self) -> dict[int, bytes]:
        """Digest of the prefix of each state on the first and the last sequence's path."""
        made = {}
        for row, path in self.paths.items():
            prefix = hashlib.md5(usedforsecurity=False)
            for depth, state in enumerate(path):
                if depth:
                    prefix.update(self.turns[row][_WIDTH * (depth - 1) : _WIDTH * depth])
                made[state] = prefix.copy().digest()
        return made

    def members(self, row: int) -> list[str]:
        """Ids of the conversations that are a sequence, in order."""
        end = int(self.row_ends[row])
        return list(map(str, self.conv_ids[end - int(self.rows[row]) : end].tolist()))


def _shard_rows(number: int, shard: Shard, before: int, after: int) -> Iterator[pa.RecordBatch]:
    states, shared, children, leaves, saved = shard.nodes(before, after)
    keys = shard.keys()
    ended: dict[int, str] = {}
    pieces = []
    for row, state in enumerate(shard.ends.tolist()):
        ids = shard.members(row)
        if not shared[state]:
            ended[state] = hashlib.sha256(",".join(ids).encode()).hexdigest()
            continue
        for k, at in enumerate(range(0, len(ids), IDS_PER_PIECE)):
            pieces.append((keys[state], k, ",".join(ids[at : at + IDS_PER_PIECE])))
    parents = shard.array.check[states]
    apart, up = shared[states], shared[parents]
    listed = states.tolist()
    n = len(states)
    root = states == 0
    yield _batch(
        n,
        kind=np.where(apart, _PART, _WHOLE),
        key=[keys[s] if x else None for s, x in zip(listed, apart.tolist(), strict=True)],
        parent_key=[
            keys[p] if x else None
            for p, x in zip(parents.tolist(), ((up | apart) & ~root).tolist(), strict=True)
        ],
        shard=np.full(n, number),
        depth=shard.depth[states],
        conv_id=shard.conv[states],
        parent_conv_id=pa.array(shard.conv[parents], pa.int64(), mask=up | apart | root),
        n_convs=shard.n_convs[states],
        n_children=children[states],
        n_leaves=leaves[states],
        saved_tokens=saved[states],
        ends_sha256=[ended.get(s, NO_IDS) for s in listed],
    )
    if pieces:
        key, piece, ids = zip(*pieces, strict=True)
        m = len(pieces)
        yield _batch(
            m, kind=np.full(m, _IDS), key=key, shard=np.full(m, number), piece=piece, ids=ids
        )


def _batch(n: int, **columns) -> pa.RecordBatch:
    """Rows of ``_NODE``; columns that are not given are null."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in _NODE.split(", ")]
    arrays = []
    for name, kind in fields:
        values = columns.get(name)
        if values is None:
            arrays.append(pa.nulls(n, kinds[kind]))
        elif isinstance(values, pa.Array):
            arrays.append(values)
        else:
            arrays.append(pa.array(values, kinds[kind]))
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def common_turns(left: bytes | None, right: bytes | None) -> int:
    """Number of turns at the start of both; -1 if one is missing."""
    if left is None or right is None:
        return -1
    n = min(len(left), len(right)) // _WIDTH
    a, b = (np.frombuffer(x[: n * _WIDTH], "<u8").reshape(n, 2) for x in (left, right))
    differ = np.flatnonzero((a != b).any(axis=1))
    return int(differ[0]) if len(differ) else n


def _limits(ranged: DataFrame) -> DataFrame:
    """(shard, before, after): turns shared with the neighbours; one row per shard."""
    edges = ranged.groupBy("shard").agg(F.min("turns").alias("low"), F.max("turns").alias("high"))
    order = Window.orderBy("shard")
    beside = edges.select(
        "shard",
        "low",
        "high",
        F.lag("high").over(order).alias("last"),
        F.lead("low").over(order).alias("next"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high, last, following = (batch.column(k).to_pylist() for k in range(1, 5))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(list(map(common_turns, last, low)), pa.int64()),
                    pa.array(list(map(common_turns, high, following)), pa.int64()),
                ],
                names=["shard", "before", "after"],
            )

    return beside.mapInArrow(run, "shard int, before long, after long")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, held = None, None

    def made() -> Iterator[pa.RecordBatch]:
        number, before, after = now
        ids = np.concatenate(held[0])
        yield from _shard_rows(number, Shard(ids, held[1], held[2]), before, after)

    for batch in batches:
        numbers = batch.column(0).to_numpy()
        edges = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True]).tolist()
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            limits = tuple(part.column(k)[0].as_py() for k in range(3))
            if limits != now:
                if now is not None:
                    yield from made()
                now, held = limits, ([], [], [])
            held[0].append(part.column(3).to_numpy())
            held[1].extend(part.column(4).to_pylist())
            held[2].extend(part.column(5).to_pylist())
    if now is not None:
        yield from made()


def _hashed_ids(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256) from pieces of ids, which are read in order and never joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.binary()), pa.array([digest.hexdigest()])],
                names=["key", "ends_sha256"],
            )

        for batch in batches:
            for key, ids in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                if key != now:
                    if now is not None:
                        yield made()
                    now, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if now is not None:
            yield made()

    ordered = pieces.repartition("key").sortWithinPartitions("key", "shard", "piece")
    return ordered.select("key", "ids").mapInArrow(run, "key binary, ends_sha256 string")


def trie_nodes(digests: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """A row per node of the trie of conversations given as turn digests.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): a node is named by its depth and its smallest member.
    """
    spark = digests.sparkSession
    made = written(sequences(digests), "sequences")
    order = ["turns", "conv_id"]
    turns = made.agg(F.sum(F.col("n_turns") + 1)).first()[0] or 0
    parts = math.ceil(turns / turns_per_shard)
    # Adaptive execution may put small ranges together, if their number is left to it.
    few = parts <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = made.repartitionByRange(*([] if few else [parts]), *order)
    ranged = ranged.sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("shard"), "conv_id", "turns", "sizes"
    )
    with arrow_rows(spark, _ROWS):
        ranged = written(ranged, "prefix_ranges")
        # A row of three numbers per shard.
        limits = F.broadcast(written(_limits(ranged), "prefix_limits"))
        nodes = (
            ranged.join(limits, "shard")
            .repartition("shard")
            .sortWithinPartitions("shard", *order)
            .select("shard", "before", "after", "conv_id", "turns", "sizes")
            .mapInArrow(_shards, _NODE)
        )
        nodes = written(nodes, "prefix_nodes")
    summed = (
        nodes.where(F.col("kind") == _PART)
        .groupBy("key")
        .agg(
            F.min("parent_key").alias("parent_key"),
            F.min("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        )
    )
    ended = _hashed_ids(nodes.where(F.col("kind") == _IDS))
    shared = written(summed.join(ended, "key", "left"), "upper_nodes").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS))
    )
    parents = shared.select(
        F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")
    )
    whole = nodes.where(F.col("kind") == _WHOLE)
    known = whole.where(F.col("parent_key").isNull()).select(*COLUMNS)
    fields = [c for c in COLUMNS if c != "parent_conv_id"]
    named = whole.where(F.col("parent_key").isNotNull()).select("parent_key", *fields)
    named = named.unionByName(shared.select("parent_key", *fields))
    joined = named.join(small_or_shuffled(parents), "parent_key", "left")
    return known.unionByName(joined.select(*COLUMNS))


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``trie_nodes`` of (conv_id, turn, role, text) rows."""
    return trie_nodes(turn_digests(conversations, conv_id, turn, role, text))

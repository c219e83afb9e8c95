"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; each of the 255 decision nodes has a tree of contexts,
the bytes before it, most recent first. A node's Krichevsky-Trofimov estimate is mixed with
the product of its children's at every depth, which weighs all prunings of the tree.

Every context that precedes at least ``LEAST`` bytes of the training text is a node, so the
model grows with the corpus. Occurrences whose context goes on to one that is not kept form
a leaf of their own below the node. Counts are exact and cover all training text. A text is
scored with the counts and weights of the training text, from a start of ``END`` bytes and
with one ``END`` byte after it (0xFF never occurs in UTF-8), so the probabilities of all
texts sum to one.

The tree is never held whole. Counts are grouped by the last three bytes, and a task weighs
the subtrees of its groups, each of at most 256 ** 2 contexts at depth 5; the nodes above,
at most 65,793 whatever the corpus, are merged on the driver and broadcast. A second pass
over the subtrees gives the probability of each distinct (context, byte). Documents are
dealt into blocks of about ``_BLOCK_BYTES``; a block asks for its distinct ones only.

The base score, an additive-smoothed unigram model over words, has an unbounded vocabulary:
words with a share of at least one in ``WORD_SHARE`` tokens, which bounds their number, are
broadcast; all others are joined.

Defined results: null text is empty and is its end alone; a null doc_id counts as an empty
one, which is in training; repeated rows are counted and scored each; without training text
every byte gets 8 bits; an empty table gives no rows; extra columns are ignored; a text
longer than a block is a block of its own and is scored slice by slice.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_size, bytes_of, written

DEPTH = 5
LEAST = 2
WORD_SHARE = 1 << 19
END = 0xFF
END_WORD = b" "  # no word has a space, so this is the end token's own key

_TOP = 2  # depth down to which nodes are merged on the driver
_SLICE = 1 << 20
_BLOCK_BYTES = 32 << 20
_PARTITIONS_A_TASK = 2  # input partitions are often smaller than a block
_CHUNK_GRAMS = 2000
_GROUP_BYTES = 4 << 20
_HELD_WORDS = 1_000_000


def held_out(doc_id: str) -> Column:
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 5 == 1


@dataclass
class Joined:
    """Lower-cased texts one after the other, each between runs of END."""

    symbols: np.ndarray
    coded: np.ndarray  # positions that are coded: all bytes and each text's first END
    text: np.ndarray  # number of the text of each position
    count: int


def join_texts(texts: list[bytes], depth: int) -> Joined:
    gap = bytes([END]) * depth
    symbols = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + depth
    ends = depth + np.cumsum(sizes) - depth
    coded = symbols != END
    coded[ends] = True
    text = np.zeros(len(symbols), np.int32)
    text[depth:] = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    return Joined(symbols, coded, text, len(texts))


def count_grams(joined: Joined, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct codes of (context, byte) with their counts, slice by slice."""
    n = len(joined.symbols)
    for low in range(depth, n, _SLICE):
        high = min(n, low + _SLICE)
        code = np.zeros(high - low, np.uint64)
        for d in range(depth, -1, -1):
            code = (code << np.uint64(8)) | joined.symbols[low - d : high - d]
        yield np.unique(code[joined.coded[low:high]], return_counts=True)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([n for _, n in parts]), len(codes))
    return codes, counts.astype(np.int64)


def _blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(block, id, held_out, text): lower-cased texts, dealt into blocks within tasks."""
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("id", docs.schema[doc_id].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("text", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = [x.lower() for x in bytes_of(batch.column(2))]
            numbers = []
            for x in texts:
                if size and size + len(x) > _BLOCK_BYTES:
                    block, size = block + 1, 0
                numbers.append(block)
                size += len(x) + 1
            columns = [
                pa.array(numbers, pa.int64()),
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    columns = docs.select(F.col(f"`{doc_id}`"), held_out(f"`{doc_id}`"), F.col(f"`{text}`"))
    tasks = max(
        docs.sparkSession.sparkContext.defaultParallelism,
        columns.rdd.getNumPartitions() // _PARTITIONS_A_TASK,
    )
    return columns.coalesce(tasks).mapInArrow(run, schema)


_PARTIAL = (
    T.StructType().add("block", "long").add("gram", "long").add("word", "binary").add("n", "long")
)


def _partials(blocks: DataFrame, depth: int) -> DataFrame:
    """Training counts of each block's distinct grams (0: held out only), and of words."""

    def gram_batches(block: int, parts: list) -> Iterator[pa.RecordBatch]:
        codes, counts = _merged(parts)
        for low in range(0, len(codes), _SLICE):
            some = slice(low, low + _SLICE)
            n = len(codes[some])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, block)),
                    pa.array(codes[some].view(np.int64)),
                    pa.nulls(n, pa.binary()),
                    pa.array(counts[some]),
                ],
                names=_PARTIAL.names,
            )

    def word_batch(counts: Counter) -> pa.RecordBatch:
        none = pa.nulls(len(counts), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                none,
                none,
                pa.array(list(counts), pa.binary()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=_PARTIAL.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        current, waiting = None, 0
        words: Counter = Counter()
        for batch in batches:
            numbers, outside = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            texts = bytes_of(batch.column(2))
            for x, out in zip(texts, outside, strict=True):
                if not out:
                    words[END_WORD] += 1
                    words.update(x.split())
                    if len(words) > _HELD_WORDS:
                        yield word_batch(words)
                        words = Counter()
            for block in np.unique(numbers).tolist():
                if block != current and parts:
                    yield from gram_batches(current, parts)
                    parts, waiting = [], 0
                current = block
                for flag in (False, True):
                    chosen = [
                        x
                        for x, b, out in zip(texts, numbers, outside, strict=True)
                        if b == block and out == flag
                    ]
                    for group in by_size(chosen, _GROUP_BYTES):
                        for codes, counts in count_grams(join_texts(group, depth), depth):
                            parts.append((codes, counts * 0 if flag else counts))
                            waiting += len(codes)
                            if waiting > 2 * len(parts[0][0]) + _SLICE:
                                parts, waiting = [_merged(parts)], 0
        if parts:
            yield from gram_batches(current, parts)
        if words:
            yield word_batch(words)

    return blocks.select("block", "held_out", "text").mapInArrow(run, _PARTIAL)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift; good to about 1e-12 for x >= 0.5."""
    shift = np.ones_like(x)
    y = x.copy()
    for _ in range(7):
        shift *= y
        y += 1
    inverse = 1 / (y * y)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def _decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones seen at each of the 255 decisions, from counts of 256 bytes."""
    zeros, ones = [], []
    for level in range(8):
        pairs = counts.reshape(len(counts), 1 << level, 2, 128 >> level).sum(axis=3)
        zeros.append(pairs[:, :, 0])
        ones.append(pairs[:, :, 1])
    return np.concatenate(zeros, axis=1), np.concatenate(ones, axis=1)


def _kt(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of the counts in any order, and that of a one to come next."""
    a, b = (x.astype(np.float64) for x in _decisions(counts))
    total = (
        _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - np.log(np.pi)
    )
    return total, (b + 0.5) / (a + b + 1)


def _logs(one: np.ndarray) -> np.ndarray:
    """Log10 probability of each byte, from those of a one at each decision."""
    log10p = np.zeros((len(one), 256))
    for bit in range(8):
        first = (1 << bit) - 1
        p = one[:, first : 2 * first + 1]
        steps = np.log10(np.stack([1 - p, p], axis=2)).reshape(len(one), 2 << bit)
        log10p += np.repeat(steps, 256 >> (bit + 1), axis=1)
    return log10p


def _context(codes: np.ndarray, d: int) -> np.ndarray:
    """The ``d`` most recent bytes of the context of each code, the latest one lowest."""
    return (codes >> np.uint64(8)) & np.uint64((1 << 8 * d) - 1)


class Level:
    """Kept contexts of one depth: byte counts, parents, and the node of each code."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, d: int, above: Level | None):
        contexts, at = np.unique(_context(codes, d), return_inverse=True)
        keep = np.bincount(at, counts, len(contexts)) >= (LEAST if d else 0)
        number = np.where(keep, np.cumsum(keep) - 1, -1)
        self.at = number[at]
        self.contexts = contexts[keep]
        k, found = len(self.contexts), self.at >= 0
        cells = self.at[found] * 256 + (codes[found] & np.uint64(255)).astype(np.int64)
        self.table = np.bincount(cells, counts[found], k * 256).reshape(k, 256)
        self.parent = np.zeros(k, np.int64)
        if above is not None:
            self.parent[self.at[found]] = above.at[found]

    def weigh(self, kept: np.ndarray, mixed: np.ndarray, inner: np.ndarray) -> None:
        """Mix with children, given the sums of their counts and log probabilities."""
        own, self.own_one = _kt(self.table)
        rest, self.rest_one = _kt(self.table - kept)
        both = np.logaddexp(own, rest + mixed)
        self.inner = inner[:, None]
        self.weight = np.where(self.inner, np.exp(own - both), 1.0)
        self.mixed = np.where(self.inner, both - np.log(2), own)

    def descend(self, fixed: np.ndarray, share: np.ndarray) -> None:
        """A one at the root is ``fixed + share`` times one at this node."""
        self.fixed = fixed + share * self.weight * self.own_one
        self.share = share * (1 - self.weight)
        self.log10p = _logs(self.fixed + self.share * self.rest_one)


def _sums(level: Level, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts and log probabilities of a level's nodes, summed by parent."""
    kept, mixed = np.zeros((k, 256)), np.zeros((k, 255))
    np.add.at(kept, level.parent, level.table)
    np.add.at(mixed, level.parent, level.mixed)
    return kept, mixed, np.bincount(level.parent, minlength=k) > 0


def forest(
    codes: np.ndarray, counts: np.ndarray, first: int, last: int, outer: dict | None = None
) -> list[Level]:
    """Weighted nodes of the depths ``first`` to ``last``.

    ``outer``: sums over the children of the deepest nodes, if these lie elsewhere.
    """
    levels: list[Level] = []
    for d in range(first, last + 1):
        levels.append(Level(codes, counts, d, levels[-1] if levels else None))
    k = len(levels[-1].contexts)
    kept, mixed, inner = np.zeros((k, 256)), np.zeros((k, 255)), np.zeros(k, bool)
    for i, c in enumerate(levels[-1].contexts.tolist() if outer else ()):
        if c in outer:
            kept[i], mixed[i], inner[i] = outer[c][:256], outer[c][256:], True
    levels[-1].weigh(kept, mixed, inner)
    for upper, lower in zip(levels[-2::-1], levels[:0:-1], strict=True):
        upper.weigh(*_sums(lower, len(upper.contexts)))
    return levels


@dataclass
class Top:
    """What subtrees need of the nodes above: by context of the top's deepest level."""

    depth: int
    contexts: np.ndarray
    node: np.ndarray
    fixed: np.ndarray
    share: np.ndarray
    log10p: np.ndarray  # if no deeper context is kept


def build_top(codes: np.ndarray, counts: np.ndarray, top: int, outer: dict) -> Top:
    codes = np.append(codes.astype(np.uint64), np.uint64(0))  # so that there is a root
    levels = forest(codes, np.append(counts, 0), 0, top, outer)
    fixed, share = np.zeros((1, 255)), np.ones((1, 255))
    for i, level in enumerate(levels):
        if i:
            fixed, share = levels[i - 1].fixed[level.parent], levels[i - 1].share[level.parent]
        level.descend(fixed, share)
    contexts, where = np.unique(_context(codes, top), return_index=True)
    ended = np.zeros((len(contexts), 256))
    for level in levels:
        at = level.at[where]
        ended[at >= 0] = level.log10p[at[at >= 0]]
    deepest = levels[-1]
    return Top(
        top, contexts, deepest.at[where], deepest.fixed, deepest.share, ended.astype(np.float32)
    )


def subtree_logs(codes: np.ndarray, counts: np.ndarray, top: Top, depth: int) -> np.ndarray:
    """Log10 probability of each code, from whole subtrees below the top."""
    levels = forest(codes, counts, top.depth + 1, depth)
    at = np.searchsorted(top.contexts, _context(codes, top.depth))
    symbols = (codes & np.uint64(255)).astype(np.int64)
    value = top.log10p[at, symbols].astype(np.float64)
    up = np.zeros(len(levels[0].contexts), np.int64)
    found = levels[0].at >= 0
    up[levels[0].at[found]] = top.node[at[found]]
    fixed, share = top.fixed[up], top.share[up]
    for i, level in enumerate(levels):
        if i:
            fixed, share = levels[i - 1].fixed[level.parent], levels[i - 1].share[level.parent]
        level.descend(fixed, share)
        found = level.at >= 0
        value[found] = level.log10p[level.at[found], symbols[found]]
    return value


def _whole_subtrees(
    batches: Iterator[pa.RecordBatch], root: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and counts, sorted by subtree, cut between subtrees into small chunks."""
    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        codes = np.concatenate([codes, batch.column(0).to_numpy().view(np.uint64)])
        counts = np.concatenate([counts, batch.column(1).to_numpy()])
        keys = _context(codes, root)
        borders = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        low = 0
        for border in borders.tolist():
            if border - low >= _CHUNK_GRAMS:
                yield codes[low:border], counts[low:border]
                low = border
        codes, counts = codes[low:], counts[low:]
    if len(codes):
        yield codes, counts


def fit(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, logp) of each distinct (context, byte), whether or not seen in training."""
    top = min(_TOP, depth - 1)

    def recent(d: int) -> Column:
        return F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit((1 << 8 * d) - 1))

    sorted_grams = (
        grams.select("gram", "n", recent(top + 1).alias("root"))
        .repartition("root")
        .sortWithinPartitions("root")
        .select("gram", "n")
    )

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, counts in _whole_subtrees(batches, top + 1):
            level = forest(codes, counts, top + 1, depth)[0]
            parents, level.parent = np.unique(
                level.contexts & np.uint64((1 << 8 * top) - 1), return_inverse=True
            )
            kept, mixed, _ = _sums(level, len(parents))
            values = np.hstack([kept, mixed])
            row, cell = np.nonzero(values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parents[row].view(np.int64)),
                    pa.array(cell.astype(np.int32)),
                    pa.array(values[row, cell]),
                ],
                names=["parent", "cell", "value"],
            )

    outer: dict[int, np.ndarray] = {}
    sums = (
        sorted_grams.mapInArrow(roots, "parent long, cell int, value double")
        .groupBy("parent", "cell")
        .agg(F.sum("value").alias("value"))
        .toArrow()
    )  # 65,536 parents at most
    for parent, cell, value in zip(*(c.to_numpy().tolist() for c in sums.columns), strict=True):
        outer.setdefault(parent, np.zeros(511))[cell] = value
    upper = (
        grams.groupBy(
            F.shiftleft(recent(top), 8).bitwiseOR(F.col("gram").bitwiseAND(F.lit(255))).alias("c")
        )
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )  # 256 rows a context at most
    model = grams.sparkSession.sparkContext.broadcast(
        build_top(upper["c"].to_numpy(), upper["n"].to_numpy(), top, outer)
    )

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, counts in _whole_subtrees(batches, top + 1):
            value = subtree_logs(codes, counts, model.value, depth)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes.view(np.int64)), pa.array(value.astype(np.float32))],
                names=["gram", "logp"],
            )

    return sorted_grams.mapInArrow(logs, "gram long, logp float")


class Lookup:
    """Values of codes, found in one step; the few that share a slot are searched for."""

    _FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.codes, self.values = codes, values
        self.shift = np.uint64(64 - max(1, (4 * len(codes)).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.slots[(codes * self._FACTOR) >> self.shift] = np.arange(len(codes))

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        at = self.slots[(codes * self._FACTOR) >> self.shift]
        missed = np.flatnonzero(self.codes[at] != codes)
        at[missed] = np.searchsorted(self.codes, codes[missed])
        return self.values[at]


def score_texts(
    texts: list[bytes], codes: np.ndarray, logs: np.ndarray, depth: int
) -> list[float]:
    """Log10 probability of each text, from those of all its codes, which are sorted."""
    log_of = Lookup(codes, logs)
    scores: list[float] = []
    for group in by_size(texts, _GROUP_BYTES):
        joined = join_texts(group, depth)
        total, n = np.zeros(joined.count), len(joined.symbols)
        for low in range(depth, n, _SLICE):
            high = min(n, low + _SLICE)
            code = np.zeros(high - low, np.uint64)
            for d in range(depth, -1, -1):
                code = (code << np.uint64(8)) | joined.symbols[low - d : high - d]
            chosen = joined.coded[low:high]
            value = log_of(code[chosen])
            total += np.bincount(joined.text[low:high][chosen], value, joined.count)
        scores += total.tolist()
    return scores


_SCORED = (
    T.StructType()
    .add("held_out", "boolean")
    .add("n_tokens", "long")
    .add("known", "long")
    .add("base", "double")
    .add("score", "double")
    .add("n_bytes", "long")
    .add("rare", T.ArrayType(T.StructType().add("word", "binary").add("n", "long")))
)


def _score(blocks: DataFrame, logs: DataFrame, frequent, depth: int) -> DataFrame:
    """Scores of each document, but for its rare words, which are listed."""
    out = T.StructType([blocks.schema["id"], *_SCORED.fields])
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def run(found: pa.Table, docs: pa.Table) -> pa.Table:
        known_logs = frequent.value
        codes = found["gram"].to_numpy().view(np.uint64)
        order = np.argsort(codes)
        texts = docs["text"].to_pylist()
        scores = score_texts(
            texts, codes[order], found["logp"].to_numpy()[order].astype(np.float64), depth
        )
        tokens, known, base, rare = [], [], [], []
        for x in texts:
            counts = Counter(x.split())
            counts[END_WORD] = 1
            tokens.append(counts.total())
            sure, value, others = 0, 0.0, []
            for word, n in counts.items():
                log = known_logs.get(word)
                if log is None:
                    others.append((word, n))
                else:
                    sure += n
                    value += n * log
            known.append(sure)
            base.append(value)
            rare.append(others)
        return pa.Table.from_arrays(
            [
                docs["id"],
                docs["held_out"],
                pa.array(tokens, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(scores, pa.float64()),
                pa.array([len(x) + 1 for x in texts], pa.int64()),
                pa.array(rare, rare_type),
            ],
            names=out.names,
        )

    return logs.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(run, out)


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, code_length).

    Every document is scored, with what those not held out teach; the code length is in
    bits per byte, the end counted as one.
    """
    context = docs.sparkSession.sparkContext
    blocks = written(_blocks(docs, doc_id, text), "blocks")
    partials = written(_partials(blocks, depth), "partials")
    asked = partials.where("gram is not null")
    grams = written(asked.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    words = written(
        partials.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    tokens, vocabulary = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = F.col("n") * WORD_SHARE >= tokens
    scale = np.log10(tokens + 0.5 * (vocabulary + 1))
    frequent = {
        bytes(word): float(np.log10(n + 0.5) - scale)
        for word, n in words.where(common).collect()  # WORD_SHARE rows at most
    }
    logs = asked.select("block", "gram").join(written(fit(grams, depth), "logs"), "gram")
    scored = written(_score(blocks, logs, context.broadcast(frequent), depth), "scored").withColumn(
        "row", F.monotonically_increasing_id()
    )
    rare = scored.select("row", F.inline("rare")).withColumnRenamed("n", "times")
    seen = words.where(~common).withColumnRenamed("n", "c")
    value = F.col("times") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - F.lit(float(scale)))
    added = (
        rare.join(seen, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(value).alias("more_base"),
        )
    )
    return scored.join(added, "row", "left").select(
        F.col("id").alias(doc_id),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
        (-F.col("score") / F.col("n_bytes") * float(np.log2(10))).alias("code_length"),
    )

"""Alignment of two tokenizers by whitespace-token anchors.

Each text, with a space in front, is tokenised whole by a byte-level BPE (A) and by a piece
BPE (B). A shared end before a token that starts with a space in both is an anchor; anchors
cut the document into windows of token ids. Where both tokenizers end together within a
window depends on its ids alone, so window alignments are memoised by their id tuples over a
batch of texts, as arrays. Shared ends cut a window's tokens into groups; the tokens that
end there are linked.

``link_counts`` counts each linked id pair over all documents, with sums combined in the
tasks, and marks the pairs that are the most frequent of their B id. ``score_links`` looks
these up for each document: from a broadcast array if a count proves the pairs few, else by a
shuffled join on the pair.

Defined results: null or empty texts, and texts whose tokens do not give back their bytes,
have no tokens and no links; a very long text is tokenised whole and held by its task alone;
ties for the highest count all are the highest; repeated rows each count and each get a row;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, by_size, byte_symbols, bytes_of, free_name, written

# Pairs of a broadcast table; a pair takes 17 bytes there.
BROADCAST_PAIRS = 2_000_000
_TEXT_ROWS, _TEXT_BYTES = 200, 1 << 20

ALIGNED = (
    T.StructType()
    .add("n_a", "long")
    .add("n_b", "long")
    .add("n_groups", "long")
    .add("n_links", "long")
    .add("groups", "string")
    .add("links_a", "binary")
    .add("links_b", "binary")
)


class ByteBpe:
    """Ids and bytes of a byte-level BPE file.

    Ids that follow the order of merges are ranks, which a faster library encodes with.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        symbols = byte_symbols()
        vocabulary = spec["model"]["vocab"]
        ranks = {
            bytes(symbols[c] for c in token): i
            for token, i in vocabulary.items()
            if token not in special
        }
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        order = [vocabulary[m.replace(" ", "", 1)] for m in merges]
        self._ranked = None
        if all(a < b for a, b in zip(order, order[1:])):
            import tiktoken

            self._ranked = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )
        self._path, self._plain = path, None

    def _encode_plainly(self, text: str) -> list[int]:
        """By the file's own library, which is loaded for texts that need it."""
        if self._plain is None:
            from tokenizers import Tokenizer

            self._plain = Tokenizer.from_file(self._path)
            self._plain.encode_special_tokens = True
        return self._plain.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> np.ndarray | list[int]:
        if self._ranked is not None:
            try:
                return self._ranked.encode_to_numpy(text, disallowed_special=())
            except BaseException as error:  # the pattern's engine panics on very long runs
                if type(error).__name__ != "PanicException":
                    raise
        return self._encode_plainly(text)


class PieceBpe:
    """Ids and bytes of a piece file; the space in front of a text is its own."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [self._bytes(i) for i in range(self._model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        if self._model.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def _ids_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Side:
    """One tokenizer's tokens as flat arrays: bytes, sizes, leading spaces, random numbers."""

    def __init__(self, tokens: list[bytes], seed: int):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self._starts = np.cumsum(self.sizes) - self.sizes
        self._flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t.startswith(b" ") for t in tokens])
        self.mixed = np.random.default_rng(seed).integers(
            0, 1 << 64, len(tokens), np.uint64, endpoint=False
        )

    def gives(self, ids: np.ndarray, data: bytes) -> bool:
        """Whether the tokens' bytes are ``data``."""
        sizes = self.sizes[ids]
        if sizes.sum() != len(data):
            return False
        made = self._flat[_ragged(self._starts[ids], sizes)]
        return bool(np.array_equal(made, np.frombuffer(data, np.uint8)))


class Windows:
    """Tokens of one side in windows that follow each other."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray):
        self.ids = ids
        self.starts = np.r_[0, ends[:-1]]
        self.sizes = ends - self.starts
        self.place = np.arange(len(ids)) - np.repeat(self.starts, self.sizes)

    def codes(self, side: Side) -> np.ndarray:
        """A number for the id tuple of each window."""
        power = np.full(int(self.sizes.max()), 0x9E3779B97F4A7C15, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        return np.add.reduceat(side.mixed[self.ids] * power[self.place], self.starts)

    def same(self, other: np.ndarray) -> bool:
        """Whether each window has the ids of the window named for it."""
        if not np.array_equal(self.sizes, self.sizes[other]):
            return False
        twin = np.repeat(self.starts[other], self.sizes) + self.place
        return bool(np.array_equal(self.ids, self.ids[twin]))

    def take(self, chosen: np.ndarray) -> Windows:
        sizes = self.sizes[chosen]
        return Windows(self.ids[_ragged(self.starts[chosen], sizes)], np.cumsum(sizes))


class Aligner:
    """Both tokenizers, and the alignment of a batch of texts.

    The windows of a batch are told apart by their id tuples; each distinct one is aligned
    and written out once, and all its occurrences take the result from there.
    """

    def __init__(self, byte_bpe: str, piece_bpe: str, pattern: str):
        self.a, self.b = ByteBpe(byte_bpe, pattern), PieceBpe(piece_bpe)
        most = max(len(self.a.tokens), len(self.b.tokens))
        self.type = _ids_type(most)
        self.sides = [Side(x.tokens, seed) for seed, x in enumerate((self.a, self.b))]
        names = [str(i).encode() for i in range(most)]
        self._digits = np.array(names).view(np.uint8).reshape(most, -1)
        self._n_digits = np.array([len(x) for x in names])

    def _shared(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in A and in B of tokens that end together; both have the same bytes."""
        ends = [np.cumsum(side.sizes[x]) for side, x in zip(self.sides, (a, b), strict=True)]
        at = np.searchsorted(ends[1], ends[0])
        both = np.flatnonzero(ends[1][at] == ends[0])
        return both, at[both]

    def _anchored(self, a: np.ndarray, b: np.ndarray) -> tuple[Windows, Windows]:
        """Windows between shared ends before tokens that start with a space in both.

        Every text starts with a space, so windows never span two texts.
        """
        ends = [np.cumsum(side.sizes[x]) for side, x in zip(self.sides, (a, b), strict=True)]
        before = np.flatnonzero(self.sides[0].spaced[a[1:]])
        at = np.searchsorted(ends[1], ends[0][before])
        shared = ends[1][at] == ends[0][before]
        before, at = before[shared] + 1, at[shared] + 1
        marked = self.sides[1].spaced[b[at]]
        return (
            Windows(a, np.r_[before[marked], len(a)]),
            Windows(b, np.r_[at[marked], len(b)]),
        )

    def _written(self, a: Windows, b: Windows, i: np.ndarray, j: np.ndarray) -> list[str]:
        """The groups of each window as text; tokens i of A and j of B end groups."""
        n = len(a.ids) + len(b.ids)
        order = np.empty((2, n), np.int64)  # id and separator in the order of the text
        for row, (windows, last, other) in enumerate(((a, i, j), (b, j, i))):
            group = np.zeros(len(windows.ids), np.int64)
            group[last[:-1] + 1] = 1
            group = np.cumsum(group)
            before = np.r_[0, other + 1][group + row]
            place = np.arange(len(windows.ids)) + before
            marks = np.full(len(windows.ids), ord(","))
            marks[last] = ord(";") if row else ord("|")
            if row:
                marks[np.cumsum(windows.sizes) - 1] = ord("\n")
            order[0, place] = windows.ids
            order[1, place] = marks
        ids, marks = order
        sizes = self._n_digits[ids]
        at = np.cumsum(sizes + 1) - sizes - 1
        made = np.empty(int(at[-1] + sizes[-1] + 1), np.uint8)
        for k in range(int(sizes.max())):
            longer = sizes > k
            made[at[longer] + k] = self._digits[ids[longer], k]
        made[at + sizes] = marks
        return made.tobytes().decode("ascii")[:-1].split("\n")

    def align_all(self, texts: list[str]) -> list[list]:
        """Columns of ``ALIGNED``, for a batch of texts."""
        chosen, ids, sizes = [], ([], []), []
        some = [k for k, t in enumerate(texts) if t]
        coded = self.b.encode([texts[k] for k in some]) if some else []
        for k, b_ids in zip(some, coded, strict=True):
            data = b" " + texts[k].encode()
            both = [np.array(x, np.int64) for x in (self.a.encode(" " + texts[k]), b_ids)]
            if all(side.gives(x, data) for side, x in zip(self.sides, both, strict=True)):
                chosen.append(k)
                sizes.append(len(data))
                for held, x in zip(ids, both, strict=True):
                    held.append(x)
        n = len(texts)
        numbers = np.zeros((3, n), np.int64)
        groups, links = [""] * n, ([b""] * n, [b""] * n)
        if chosen:
            found = self._align(np.concatenate(ids[0]), np.concatenate(ids[1]), sizes)
            for k, a_ids, b_ids, (n_links, text, links_a, links_b) in zip(
                chosen, *ids, found, strict=True
            ):
                numbers[:, k] = len(a_ids), len(b_ids), n_links
                groups[k], links[0][k], links[1][k] = text, links_a, links_b
        n_a, n_b, n_links = numbers
        return [n_a, n_b, n_links, n_links, groups, *links]

    def _align(self, a: np.ndarray, b: np.ndarray, sizes: list[int]) -> Iterator[tuple]:
        """(links, groups, linked ids of A, of B) of texts of these sizes in bytes."""
        all_a, all_b = self._anchored(a, b)
        codes = 31 * all_a.codes(self.sides[0]) + all_b.codes(self.sides[1])
        _, first, memo = np.unique(codes, return_index=True, return_inverse=True)
        if not (all_a.same(first[memo]) and all_b.same(first[memo])):
            first = memo = np.arange(len(codes))  # two windows have one code
        one_a, one_b = all_a.take(first), all_b.take(first)
        i, j = self._shared(one_a.ids, one_b.ids)
        texts = self._written(one_a, one_b, i, j)
        window = np.repeat(np.arange(len(first)), one_a.sizes)[i]
        n_links = np.bincount(window, minlength=len(first))
        starts = np.cumsum(n_links) - n_links
        at = _ragged(starts[memo], n_links[memo])
        links = [
            x.ids[ends].astype(self.type)[at] for x, ends in ((one_a, i), (one_b, j))
        ]
        # Texts end where windows end.
        bytes_of_windows = np.add.reduceat(self.sides[0].sizes[a], all_a.starts)
        last = np.searchsorted(np.cumsum(bytes_of_windows), np.cumsum(sizes)) + 1
        link_ends = np.r_[0, np.cumsum(n_links[memo])][last].tolist()
        memo = memo.tolist()
        x = low = 0
        for y, high in zip(last.tolist(), link_ends, strict=True):
            groups = ";".join([texts[k] for k in memo[x:y]])
            yield high - low, groups, *(side[low:high].tobytes() for side in links)
            x, low = y, high


@lru_cache(maxsize=1)
def aligner(byte_bpe: str, piece_bpe: str, pattern: str) -> Aligner:
    """The worker's aligner."""
    return Aligner(byte_bpe, piece_bpe, pattern)


def align_documents(
    docs: DataFrame,
    byte_bpe: str,
    piece_bpe: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, links_a, links_b), a row per document.

    ``groups`` is the alignment as text, ``a1,a2|b1;a3|b2,b3``; the linked ids are packed
    little-endian, one entry per link in both columns. ``pattern`` splits a text before A's
    merges.
    """
    schema = T.StructType([docs.schema[doc_id], *ALIGNED])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_bpe, piece_bpe, pattern)
        for batch in batches:
            at = 0
            for group in by_size(bytes_of(batch.column(1)), _TEXT_BYTES):
                columns = [
                    pa.array(values, kind)
                    for values, kind in zip(
                        both.align_all([x.decode() for x in group]),
                        [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()],
                        strict=True,
                    )
                ]
                ids = batch.column(0).slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays([ids, *columns], names=names)

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def aligned_rows(docs: DataFrame) -> arrow_rows:
    """Setting for whatever runs ``align_documents``: few texts in an Arrow batch."""
    return arrow_rows(docs.sparkSession, _TEXT_ROWS)


def _codes(batch: pa.RecordBatch, a: int, b: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Links of all rows as A id * 2**32 + B id, and how many each row has."""
    left, right = (batch.column(k).to_pylist() for k in (a, b))
    sizes = np.array([len(x) for x in left], np.int64) // np.dtype(kind).itemsize
    ids = [np.frombuffer(b"".join(x), kind).astype(np.int64) for x in (left, right)]
    return (ids[0] << 32) | ids[1], sizes


_HELD_CODES = 1 << 21


def link_counts(aligned: DataFrame, kind: str = "<u2") -> DataFrame:
    """(a_id, b_id, n, best): links of each id pair in all documents.

    ``best`` says that no pair of the same B id is linked more often. ``kind`` is the type of
    the packed ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(codes), pa.array(n.astype(np.int64))], names=["code", "n"]
            )

        for batch in batches:
            codes, _ = _codes(batch, 0, 1, kind)
            held.append(codes)
            size += len(codes)
            if size >= _HELD_CODES:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    counts = (
        aligned.select("links_a", "links_b")
        .mapInArrow(run, "code long, n long")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
    )
    pairs = counts.select(
        F.shiftright("code", 32).cast("int").alias("a_id"),
        F.col("code").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"),
        "n",
    )
    # A B id has at most as many pairs as A has ids.
    highest = F.max("n").over(Window.partitionBy("b_id"))
    return pairs.withColumn("best", F.col("n") == highest)


def score_links(
    aligned: DataFrame, pairs: DataFrame, kind: str = "<u2", most: int = BROADCAST_PAIRS
) -> DataFrame:
    """Replace the packed links with ``n_best`` and ``count_sum``.

    Both frames have to be stored tables: they are read more than once.
    """
    if pairs.limit(most + 1).count() <= most:
        return _score_by_array(aligned, pairs, kind)
    return _score_by_join(aligned, pairs, kind)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, since each may have many links."""
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXT_ROWS):
            yield batch.slice(at, _TEXT_ROWS)


_SCORES = T.StructType().add("n_best", "long").add("count_sum", "long")


def _score_by_array(aligned: DataFrame, pairs: DataFrame, kind: str) -> DataFrame:
    code = F.shiftleft(F.col("a_id").cast("long"), 32) + F.col("b_id")
    rows = pairs.select(code.alias("code"), "n", "best").toArrow()
    codes = rows.column("code").to_numpy()
    order = np.argsort(codes)
    table = (codes[order], rows.column("n").to_numpy()[order],
             rows.column("best").to_numpy(zero_copy_only=False)[order])
    shared = aligned.sparkSession.sparkContext.broadcast(table)
    kept = [f for f in aligned.schema if f.name not in ("links_a", "links_b")]
    schema = T.StructType([*kept, *_SCORES])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = shared.value
        for batch in _parts(batches):
            links, sizes = _codes(batch, len(kept), len(kept) + 1, kind)
            # Equal links are looked up once.
            distinct, place = np.unique(links, return_inverse=True)
            at = np.searchsorted(codes, distinct)[place]
            sums = []
            for values in (best[at].astype(np.int64), n[at]):
                total = np.r_[0, np.cumsum(values)]
                ends = np.cumsum(sizes)
                sums.append(pa.array(total[ends] - total[ends - sizes]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *sums], names=names)

    source = aligned.select(*[F.col(f"`{f.name}`") for f in kept], "links_a", "links_b")
    return source.mapInArrow(run, schema)


def _score_by_join(aligned: DataFrame, pairs: DataFrame, kind: str) -> DataFrame:
    """Links of a document are counted by pair first, so a frequent pair is a row of it once."""
    row = free_name(aligned, "row")
    numbered = written(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            links, sizes = _codes(batch, 1, 2, kind)
            ids = np.repeat(batch.column(0).to_numpy(), sizes)
            both, times = np.unique(np.stack([ids, links]), axis=1, return_counts=True)
            columns = [both[0], both[1] >> 32, both[1] & 0xFFFFFFFF, times]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns],
                names=["row", "a_id", "b_id", "times"],
            )

    linked = numbered.select(row, "links_a", "links_b").mapInArrow(
        run, "row long, a_id long, b_id long, times long"
    )
    sums = (
        linked.join(pairs, ["a_id", "b_id"])
        .groupBy(F.col("row").alias(row))
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    joined = numbered.drop("links_a", "links_b").join(sums, row, "left").drop(row)
    return joined.withColumns(
        {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    )

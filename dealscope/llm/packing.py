"""Best-fit packing of token sequences, by hierarchical residual merging.

Each task packs its own pieces by best fit, largest first, and emits the bins that are
nearly full. The bins that are not go on as items of the next round: they are dealt anew to
at most half as many tasks, with other partners, and packed by best fit again, whole or piece
by piece, and so on like a tree. Rounds end at the root, when one task got all that was left,
or when a round joins nothing any more. Then the rest is emitted as it is. No round holds more than ``items_per_task`` bins in a
task, and no piece is dropped.

A piece is (doc_id, piece, start, length, ids, offset): ids are little-endian unsigned
32-bit token ids, the offset is its place in the bin. Bins carry their pieces, which is
bounded by the capacity, so nothing has to be joined back. Each round is written to the shared folder before the next one reads it.

Defined results: null text is empty and gives the end id alone; only documents longer than
the capacity are cut; of items of equal size the first that a task read comes first; very
long texts are encoded whole, about two megabytes of text at a time; repeated rows are packed one by one; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, by_size, byte_symbols, bytes_of, written

CAPACITY = 2048
END_ID = 0
ITEMS_PER_TASK = 20_000
NEARLY_FULL = 0.995

PIECE = (
    T.StructType()
    .add("doc_id", "long")
    .add("piece", "integer")
    .add("start", "long")
    .add("length", "long")
    .add("ids", "binary")
    .add("offset", "long")
)
BIN = (
    T.StructType()
    .add("fill", "integer")
    .add("full", "boolean")
    .add("pieces", T.ArrayType(PIECE))
)

_ARROW_PIECE = pa.struct(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("offset", pa.int64()),
    ]
)
_ARROW_BIN = pa.schema(
    [("fill", pa.int32()), ("full", pa.bool_()), ("pieces", pa.list_(_ARROW_PIECE))]
)


class LetterWords:
    """Ids of words of plain letters, many at a time, by a library that merges by rank.

    The vocabulary marks the last symbol of a word; here a zero byte behind the word does.
    Marked single bytes have lower ids than all merges, so the mark joins the last byte
    first, and the other merges follow in the order of their ids, as in the tokenizer.
    """

    _SUFFIX = "</w>"
    # Letters up to here are lower-cased and composed alike everywhere.
    _LAST = "\u052f"

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        symbols = byte_symbols()
        ranks = {}
        for token, i in model["vocab"].items():
            core = token.removesuffix(self._SUFFIX)
            if core and all(c in symbols for c in core):
                end = b"\0" if core != token else b""
                ranks[bytes(symbols[c] for c in core) + end] = i
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"]["".join(m)] for m in merges]
        marked = [ranks.get(bytes([b, 0]), len(ranks)) for b in range(1, 256)]
        self.usable = (
            model.get("end_of_word_suffix") == self._SUFFIX
            and all(a < b for a, b in zip(order, order[1:]))
            and max(marked) < order[0]
        )
        self._ends = np.zeros(max(ranks.values()) + 1, bool)
        self._ends[[i for token, i in ranks.items() if token[-1] == 0 and len(token) > 1]] = True
        self._bpe = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        )

    def fits(self, word: bytes) -> bool:
        """Whether the tokenizer takes the word as it is, as one run of letters.

        A-Z are in lower case already.
        """
        if word.isascii():
            return word.isalpha()
        text = word.decode()
        if not text.isalpha() or max(text) > self._LAST:
            return False
        return text.lower() == text and is_normalized("NFC", text)

    def encode(self, words: list[bytes]) -> tuple[bytes, list[int]]:
        """Ids of the words, one word after the other, and the bytes that each one ends at."""
        text = b"\0".join([*words, b""]).decode()
        ids = self._bpe.encode_to_numpy(text, disallowed_special=())
        ids = ids.astype("<u4", copy=False)
        return ids.tobytes(), (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()


class WordCache(dict):
    """Token ids, as bytes, of text between ASCII white space.

    The tokenizer drops white space and no token or character normalisation spans it, so a
    text's ids are those of its words, one after the other. New words of plain letters are
    encoded together by rank; others with a special token between them, which splits a text
    before anything else. Final punctuation behind a letter or digit is a token run of its
    own and is looked up apart. The cache is emptied when full and lives as long as the
    worker process.
    """

    MOST_BYTES = 64 << 20
    _ENTRY = 170  # bytes of an entry beside its word and ids
    _SPECIAL = b"<|"
    _BETWEEN = "<|startoftext|>"
    _FINAL = b".,;:!?"
    _TOGETHER = 20_000

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(self._BETWEEN)
        self.letters = LetterWords(path)
        self.held = 0

    def _core(self, word: bytes) -> bytes:
        """A word without final punctuation, if a token border lies between; else empty."""
        core = word.rstrip(self._FINAL)
        return core if core[-1:].isalnum() else b""

    def _keep(self, words: list[bytes], data: bytes, starts: list[int], ends: list[int]) -> None:
        self.update(zip(words, map(data.__getitem__, map(slice, starts, ends)), strict=True))
        self.held += len(data) + sum(map(len, words)) + self._ENTRY * len(words)

    def _encode(self, words: list[bytes]) -> None:
        others = words
        if self.letters.usable:
            fitting = [w for w in words if self.letters.fits(w)]
            if fitting:
                data, ends = self.letters.encode(fitting)
                self._keep(fitting, data, [0, *ends[:-1]], ends)
                others = [w for w in words if w not in self]
        alone = [w for w in others if self.between is None or self._SPECIAL in w]
        for word in alone:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            data = np.array(ids, "<u4").tobytes()
            self._keep([word], data, [0], [len(data)])
        others = [w for w in others if w not in self]
        for at in range(0, len(others), self._TOGETHER):
            some = others[at : at + self._TOGETHER]
            text = self._BETWEEN.join(w.decode() for w in some)
            (coded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(coded.ids, "<u4")
            cuts = np.flatnonzero(ids == self.between)
            data = ids.tobytes()
            first = [0, *(4 * (cuts + 1)).tolist()]
            last = [*(4 * cuts).tolist(), len(data)]
            self._keep(some, data, first, last)

    def _learn(self, words: set[bytes]) -> list[bytes]:
        """Add what is missing; those with final punctuation are returned, to be dropped."""
        if self.held > self.MOST_BYTES:
            self.clear()
            self.held = 0
        new = {w for w in words if w not in self}
        ended = [w for w in new if w[-1] in self._FINAL]
        cores = {w: core for w in ended if (core := self._core(w))}
        needed = new.difference(cores)
        needed.update(cores.values(), {w[len(core) :] for w, core in cores.items()})
        self._encode([w for w in needed if w not in self])
        for word, core in cores.items():
            self[word] = self[core] + self[word[len(core) :]]
        return list(cores)

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. A-Z go in lower case first, as the tokenizer does it."""
        split = [(t if self._SPECIAL in t else t.lower()).split() for t in texts]
        composed = self._learn(set().union(*split))
        ids = [b"".join(map(self.__getitem__, words)) for words in split]
        for word in composed:
            del self[word]
        return ids


@lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """The worker's cache for a tokenizer file."""
    return WordCache(path)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indexes of the items of each bin, by best fit with the largest items first.

    Open bins are kept by the room they have; a bit set over rooms finds the tightest one.
    """
    order = sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True)
    rooms: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    bits = 0
    bins = []
    for item in order:
        size = sizes[item]
        fitting = bits >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                bits &= ~(1 << room)
            chosen.append(item)
        else:
            room, chosen = capacity, [item]
            bins.append(chosen)
        room -= size
        if room:
            rooms[room].append(chosen)
            bits |= 1 << room
    return bins


# Rows of an Arrow batch, of documents that come in and of bins that go out.
_DOCUMENT_ROWS, _BIN_ROWS = 1000, 256


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _BIN_ROWS):
        yield batch.slice(at, _BIN_ROWS)


def _bins(items: list[tuple[int, list]], capacity: int, nearly: int) -> pa.RecordBatch:
    """Pack items of (size, pieces); a piece ends with its offset in the item."""
    sizes = [size for size, _ in items]
    fills, pieces = [], []
    for members in best_fit(sizes, capacity):
        fill, placed = 0, []
        for i in members:
            placed += [(*p[:-1], fill + p[-1]) for p in items[i][1]]
            fill += sizes[i]
        fills.append(fill)
        pieces.append(placed)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(fills, pa.int32()),
            pa.array([f >= nearly for f in fills], pa.bool_()),
            pa.array(pieces, pa.list_(_ARROW_PIECE)),
        ],
        schema=_ARROW_BIN,
    )


_TEXT_BYTES = 2 << 20
# A round's pieces wait in the task until so many bytes of ids have come.
_HELD_BYTES = 16 << 20


def _first_round(docs: DataFrame, tokenizer: str, capacity: int, nearly: int) -> DataFrame:
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(tokenizer)
        items, held = [], 0
        for batch in batches:
            numbers = iter(batch.column(0).to_pylist())
            groups = by_size(bytes_of(batch.column(1)), _TEXT_BYTES)
            for ids in (x + end for group in groups for x in cache.encode_all(group)):
                doc_id = next(numbers)
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    size = len(part) // 4
                    items.append((size, [(doc_id, k, at // 4, size, part, 0)]))
                held += len(ids)
                if held >= _HELD_BYTES or len(items) >= ITEMS_PER_TASK:
                    yield from _sliced(_bins(items, capacity, nearly))
                    items, held = [], 0
        if items:
            yield from _sliced(_bins(items, capacity, nearly))
        pa.default_memory_pool().release_unused()  # the worker lives on for later stages

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, BIN)


def _next_round(
    bins: DataFrame, turn: int, tasks: int, capacity: int, nearly: int
) -> DataFrame:
    """Underfull bins are items now; they are dealt by a hash of their first piece.

    Bins more than half full cannot join each other. So their pieces are also packed one by
    one, and of the two packings that with fewer bins stays.
    """
    first = F.col("pieces")[0]

    def merged(items: list[tuple[int, list]]) -> pa.RecordBatch:
        opened = [(p[3], [(*p[:-1], 0)]) for _, pieces in items for p in pieces]
        both = [_bins(items, capacity, nearly), _bins(opened, capacity, nearly)]
        return min(both, key=len)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple[int, list]] = []
        held = 0
        for batch in batches:
            for fill, pieces in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                items.append((fill, [tuple(p.values()) for p in pieces]))
                held += 4 * fill
                if held >= 4 * _HELD_BYTES or len(items) >= 2 * ITEMS_PER_TASK:
                    yield from _sliced(merged(items))
                    items, held = [], 0
        if items:
            yield from _sliced(merged(items))

    dealt = bins.repartition(tasks, F.xxhash64(first["doc_id"], first["piece"], "fill", F.lit(turn)))
    return dealt.select("fill", "pieces").mapInArrow(run, BIN)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    nearly_full: float = NEARLY_FULL,
    items_per_task: int = ITEMS_PER_TASK,
) -> DataFrame:
    """Pack (doc_id, text) into sequences: a row per piece with its place and ids."""
    nearly = math.ceil(capacity * nearly_full)
    with arrow_rows(docs.sparkSession, _DOCUMENT_ROWS):
        rounds = [written(_first_round(docs, tokenizer, capacity, nearly), "packed")]
    left = rounds[-1].where("not full").count()
    tasks = None
    while left > 1 and tasks != 1:
        wanted = math.ceil(left / items_per_task)
        tasks = wanted if tasks is None else min(wanted, tasks // 2)
        underfull = rounds[-1].where("not full")
        rounds[-1] = rounds[-1].where("full")
        rounds.append(written(_next_round(underfull, len(rounds), tasks, capacity, nearly), "packed"))
        after, done = rounds[-1].agg(
            F.count_if(~F.col("full")), F.count_if(F.col("full"))
        ).first()
        saved, left = left - after - done, after
        if not saved:
            break
    bins = rounds[0]
    for more in rounds[1:]:
        bins = bins.unionByName(more)
    return _placed(bins)


def _placed(bins: DataFrame) -> DataFrame:
    """A row per piece with its sequence's number."""
    numbered = bins.select(F.monotonically_increasing_id().alias("sequence_id"), "pieces")
    return numbered.select("sequence_id", F.inline("pieces"))

"""Token counts that follow edits.

A document is kept as a sequence of pre-token segments with a tree of sums over them: each
leaf is a run of pre-tokens, with its number of characters and of tokens; each inner node
has the sums of its children. An edit is located by character offset in the tree, only the
leaves it touches are encoded again, together with the pre-token of context on each side,
and the sums above them are updated.

Segments are cut only before white space that follows other text. The byte-level tokenizer
never lets a token span such a place, so counts of segments add up to those of the text.

Defined results: null text is empty and has no tokens; null or no edits change nothing;
edits are applied in order, each to the text the ones before it left; offsets are clipped to
the text, an end before the start counts as the start, a null replacement is empty; repeated
rows are kept each; an empty table gives no rows; extra columns pass through, and a column
named like a new one is replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, texts_of

LEAF = 32
_LONG_LEAF = 16_384
# A pre-token begins with ASCII white space that follows other text. White space that begins
# with another character (no-break space, separators) is left inside a pre-token.
_PRE_TOKEN = re.compile(r"\s*\S+(?:[^\S \t-\r]\s*\S+)*|\s+")

EDIT = T.StructType().add("start", "long").add("end", "long").add("replacement", "string")


class CountCache(dict):
    """Number of tokens of a pre-token; emptied when full."""

    LIMIT = 1_000_000

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= 64:
            if len(self) >= self.LIMIT:
                self.clear()
            self[piece] = n
        return n


class SegmentTree:
    """Sums over leaves; ``sums[i]`` is that of the leaves below node i, the root is 1."""

    def __init__(self, values: list[int]):
        self.size = 1
        while self.size < max(1, len(values)):
            self.size *= 2
        self.sums = [0] * self.size + values + [0] * (self.size - len(values))
        for i in range(self.size - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def total(self) -> int:
        return self.sums[1]

    def put(self, leaf: int, value: int) -> None:
        i = self.size + leaf
        change = value - self.sums[i]
        while i:
            self.sums[i] += change
            i //= 2

    def find(self, offset: int) -> tuple[int, int]:
        """The leaf that holds a character offset, and the characters before that leaf."""
        i, before = 1, 0
        while i < self.size:
            i *= 2
            if before + self.sums[i] <= offset:
                before += self.sums[i]
                i += 1
        return i - self.size, before


class Document:
    """Text of a document in leaves, with trees of characters and tokens."""

    def __init__(self, text: str, counts: CountCache):
        self.counts = counts
        self.encoded = 0
        pieces = _PRE_TOKEN.findall(text)
        self.leaves = ["".join(pieces[i : i + LEAF]) for i in range(0, len(pieces), LEAF)]
        tokens = [
            sum(map(counts.__getitem__, pieces[i : i + LEAF]))
            for i in range(0, len(pieces), LEAF)
        ]
        self._plant(tokens)

    def _plant(self, tokens: list[int]) -> None:
        self.chars = SegmentTree([len(x) for x in self.leaves])
        self.tokens = SegmentTree(tokens)

    @property
    def total(self) -> int:
        return self.tokens.total

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace characters ``start:end``; encode the touched leaves again.

        The first touched leaf holds the character before the edit and the last one that
        behind it. So both outer borders lie between characters that stay, and stay borders
        between pre-tokens. A leaf that is left empty has sums of zero.
        """
        length = self.chars.total
        start = min(max(0, start), length)
        end = min(max(start, end), length)
        if start == end and not replacement:
            return
        if not length:
            encoded = self.encoded + len(_PRE_TOKEN.findall(replacement))
            self.__init__(replacement, self.counts)
            self.encoded = encoded
            return
        low, low_at = self.chars.find(max(0, start - 1))
        high, high_at = self.chars.find(min(end, length - 1))
        merged = (
            self.leaves[low][: start - low_at] + replacement + self.leaves[high][end - high_at :]
        )
        self._set(low, merged)
        for leaf in range(low + 1, high + 1):
            self._set(leaf, "")
        if len(merged) > _LONG_LEAF:
            self._split(low)

    def _set(self, leaf: int, text: str) -> None:
        pieces = _PRE_TOKEN.findall(text)
        self.encoded += len(pieces)
        self.leaves[leaf] = text
        self.chars.put(leaf, len(text))
        self.tokens.put(leaf, sum(map(self.counts.__getitem__, pieces)))

    def _split(self, leaf: int) -> None:
        """Deal a leaf that grew long into several, in new trees over the known sums."""
        pieces = _PRE_TOKEN.findall(self.leaves[leaf])
        parts = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)]
        known = [self.tokens.sums[self.tokens.size + i] for i in range(len(self.leaves))]
        new = [sum(map(self.counts.__getitem__, p)) for p in parts]
        self.leaves[leaf : leaf + 1] = ["".join(p) for p in parts]
        self._plant(known[:leaf] + new + known[leaf + 1 :])


def count_with_edits(
    docs: DataFrame, tokenizer: str, text: str = "text", edits: str = "edits"
) -> DataFrame:
    """Apply the array of (start, end, replacement) in ``edits`` to each document.

    Adds ``tokens_before``, ``tokens_after``, ``pre_tokens`` (of the text before),
    ``encoded_again`` (pre-tokens encoded for the edits) and ``edited``, the new text.
    """
    new = (
        T.StructType()
        .add("tokens_before", "long")
        .add("tokens_after", "long")
        .add("pre_tokens", "long")
        .add("encoded_again", "long")
        .add("edited", "string")
    )

    def compute():
        counts = CountCache(tokenizer)

        def follow(value: str, changes: list[dict] | None) -> tuple:
            doc = Document(value, counts)
            before, pieces = doc.total, len(_PRE_TOKEN.findall(value))
            for x in changes or ():
                if x is not None:
                    start = x["start"] or 0
                    end = start if x["end"] is None else x["end"]
                    doc.edit(start, end, x["replacement"] or "")
            return before, doc.total, pieces, doc.encoded, doc.text

        def step(columns: list[pa.Array]) -> list:
            rows = [
                follow(*x) for x in zip(texts_of(columns[0]), columns[1].to_pylist(), strict=True)
            ]
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 5

        return step

    return append_columns(docs, [text, edits], new, compute)


def edit(start: Column, end: Column, replacement: Column) -> Column:
    """One edit as a struct."""
    return F.struct(
        start.cast("long").alias("start"),
        end.cast("long").alias("end"),
        replacement.alias("replacement"),
    )

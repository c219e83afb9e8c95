"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are hashed in k-grams, and of every window of consecutive k-gram hashes the smallest
is kept as a fingerprint. A span of ``window`` words holds ``window - k + 1`` k-grams; with
that as the winnowing width, every span of at least ``window`` words that a document shares
with an item has a fingerprint in both. Fingerprints are joined, each hit is extended to the
windows around it, and those are compared with the item's windows word for word.

Documents are cut into segments that overlap by a window less one word, so no array grows
with a document. Item fingerprints are broadcast in blocks of ``BLOCK`` rows; a larger
benchmark means more blocks. Fingerprints carry their segment position in the low bits.

Arrays are opened with ``explode_outer``: for an inner ``explode`` Spark infers a filter and
pushes it down to the scan, where it computes all hashes a second time.

Defined results: null text has no words; a document without words, an empty benchmark and
an empty table give no hits; an item with fewer words than the window, but not none, is one
window of its own length; items without words never occur; repeated items count by id;
repeated documents are judged by (doc_id, text); extra columns pass through, and a column
named like a new one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, small_or_shuffled, written

WINDOW = 10
GRAM = 5
BLOCK = 200_000
_SEGMENT = 1000
_POSITION_BITS = 12


def words_of(text: Column) -> Column:
    """Words of a text after A-Z are lower-cased: digits, letters a-z, and all beyond ASCII."""
    cut = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(cut, "")


def _segments(docs: DataFrame, window: int) -> DataFrame:
    """(key, words, start): overlapping segments that together hold every window."""
    n = F.size("words")
    last = F.ceil((n - (window - 1)) / _SEGMENT).cast("int") - 1
    return (
        docs.select(
            "key",
            "words",
            F.explode_outer(F.when(n >= window, F.sequence(F.lit(0), last))).alias("s"),
        )
        .select(
            "key",
            (F.col("s") * _SEGMENT).alias("start"),
            F.slice("words", F.col("s") * _SEGMENT + 1, _SEGMENT + window - 1).alias("words"),
        )
    )


def _fingerprints(segments: DataFrame, window: int, gram: int) -> DataFrame:
    """Add ``prints``: the kept hashes of each segment, shifted left over their positions."""
    width = window - gram + 1
    hashed = segments.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn(
        "g",
        F.transform(
            F.sequence(F.lit(0), F.size("h") - gram),
            lambda i: F.shiftleft(
                F.xxhash64(*[F.get("h", i + j) for j in range(gram)]), _POSITION_BITS
            ).bitwiseOR(i.cast("long")),
        ),
    )
    if width == 1:
        return grams.withColumn("prints", F.col("g"))
    smallest = F.transform(
        F.sequence(F.lit(0), F.size("g") - width),
        lambda i: F.least(*[F.get("g", i + j) for j in range(width)]),
    )
    return grams.withColumn("prints", F.array_distinct(smallest))


def _hash(printed: Column) -> Column:
    return F.shiftright(printed, _POSITION_BITS)


def _position(printed: Column) -> Column:
    return printed.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).cast("int")


def _item_windows(items: DataFrame, window: int, exact: bool) -> DataFrame:
    """(item_id, span): the distinct windows of the items, as joined words.

    ``exact``: only of items with just so many words, for windows that are short items.
    """
    n = F.size("words")
    chosen = items.where(n == window) if exact else items.where(n >= window)
    starts = F.sequence(F.lit(1), n - (window - 1))
    return (
        chosen.select("item_id", "words", F.explode(starts).alias("at"))
        .select("item_id", F.array_join(F.slice("words", F.col("at"), window), " ").alias("span"))
        .distinct()
    )


def _occurrences(docs: DataFrame, spans: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, first, last, item_id) of every item window in a document."""
    split = spans.select(F.lit(0).alias("key"), F.split("span", " ").alias("words"))
    item_prints = written(
        _fingerprints(split.withColumn("start", F.lit(0)), window, gram)
        .select(F.explode_outer("prints").alias("p"))
        .select(_hash(F.col("p")).alias("f"))
        .distinct(),
        "item_prints",
    )
    blocks = -(-item_prints.count() // BLOCK)
    before = window - gram
    found = None
    for block in range(blocks):
        part = item_prints.where(F.pmod("f", F.lit(blocks)) == block) if blocks > 1 else item_prints
        prints = (
            _fingerprints(_segments(docs, window), window, gram)
            .select("key", "start", "words", F.explode_outer("prints").alias("p"))
            .withColumn("f", _hash(F.col("p")))
            .join(F.broadcast(part), "f", "left_semi")
        )
        low = F.greatest(F.lit(0), _position(F.col("p")) - before)
        hits = prints.select(
            "key",
            (F.col("start") + low).alias("first"),
            F.slice("words", low + 1, _position(F.col("p")) - low + window).alias("around"),
        )
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return None
    extra = F.size("around") - window
    starts = F.when(extra >= 0, F.sequence(F.lit(0), extra))
    candidates = (
        found.select("key", "first", "around", F.explode_outer(starts).alias("i"))
        .select(
            "key",
            (F.col("first") + F.col("i")).alias("first"),
            F.array_join(F.slice("around", F.col("i") + 1, window), " ").alias("span"),
        )
    )
    return candidates.join(spans, "span").select(
        "key", "first", (F.col("first") + window).alias("last"), "item_id"
    )


def _covered(spans: Column) -> Column:
    """Number of words in the union of sorted (first, last) spans, last exclusive."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        spans,
        start,
        lambda acc, x: F.struct(
            (
                acc["n"]
                + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"], acc["end"]))
            ).alias("n"),
            F.greatest(acc["end"], x["last"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def _key(doc_id: str, text: str) -> Column:
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("text"))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """A row per contaminated document: (key, n_hit, spans, items), from all its windows."""
    worded = docs.select(_key(doc_id, text).alias("key"), words_of(F.col(text)).alias("words"))
    parts = written(
        items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0),
        "items",
    )
    lengths = [
        r[0]
        for r in parts.select(F.least(F.size("words"), F.lit(window)).alias("n"))
        .distinct()
        .orderBy("n")
        .collect()
    ]  # at most ``window`` rows
    every = None
    for n in lengths:
        spans = written(_item_windows(parts, n, exact=n < window), "spans")
        found = _occurrences(worded, spans, n, min(gram, n))
        if found is not None:
            every = found if every is None else every.unionByName(found)
    if every is None:
        nothing = """key struct<id:bigint,text:bigint>, n_hit bigint,
            spans array<struct<first:int,last:int>>, items array<string>"""
        return docs.sparkSession.createDataFrame([], nothing)
    return (
        every.groupBy("key")
        .agg(
            F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
        .select("key", _covered(F.col("spans")).alias("n_hit"), "spans", "items")
    )


def mark_contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Digest of the leaks of each document, without its text."""
    leaks = written(find_leaks(docs, items, doc_id, text, window, gram), "leaks").select(
        F.col("key.id").alias("_id"), F.col("key.text").alias("_text"), "n_hit", "items"
    )
    rows = docs.select(
        F.col(doc_id),
        F.xxhash64(F.col(text)).alias("_hash"),
        F.size(words_of(F.col(text))).cast("long").alias("n_words"),
    )
    met = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text"))
    none = F.array().cast("array<string>")
    listed = F.coalesce("items", none)
    return rows.join(small_or_shuffled(leaks), met, "left").select(
        doc_id,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents without a shared window, with all their columns."""
    leaks = written(find_leaks(docs, items, doc_id, text).select("key"), "leaks").select(
        F.col("key.id").alias("_leak_id"), F.col("key.text").alias("_leak_text")
    )
    met = docs[doc_id].eqNullSafe(leaks["_leak_id"]) & (
        F.xxhash64(docs[text]) == leaks["_leak_text"]
    )
    return docs.join(small_or_shuffled(leaks), met, "left_anti")

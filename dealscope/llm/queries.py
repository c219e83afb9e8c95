"""A query per operator, over a folder of test tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import (
    bbit_minhash,
    context_tree,
    conversation_trie,
    host_rules,
    ordinal,
    packing,
    secret_scan,
    simhash,
    token_alignment,
    token_edits,
    url_filter,
    warc,
    winnowing,
)
from .common import table, written

PACK_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COUNT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ALIGN_TOKENIZERS = COUNT_TOKENIZER, public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of each document: counts, digest of the base spans, and all spans."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secret_scan.secret_digest(docs).drop("text")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on each page's url."""
    return url_filter.judge_urls(table(spark, folder, "pages").select("page_id", "url")).drop(
        "url"
    )


def op3_warc_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to an archive, normalised, and read back by offset."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    pages = table(spark, folder, "pages").select("page_id", html.alias("payload"))
    return warc.read_records(warc.archive_pages(pages), payloads=False).drop("payload")


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces in their sequences."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, PACK_TOKENIZER).select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that lie in a benchmark window."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return winnowing.mark_contaminated(docs, table(spark, folder, "benchmark"))


def op6_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Language-model scores of each document."""
    return context_tree.score_documents(
        table(spark, folder, "documents").select("doc_id", "text")
    )


def op7_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of each document and whether it is kept."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return host_rules.judge_documents(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op8_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and probability of the highest grade of each document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = ordinal.train(docs, table(spark, folder, "labels"))
    return ordinal.rate_documents(docs, model).drop("text")


def op9_token_edits(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of each document before and after edits made from its own columns.

    The language goes before the text, the middle tenth is replaced with the source's name,
    and the last twentieth is cut off.
    """
    n = F.char_length(F.coalesce("text", F.lit("")))
    lang = F.concat(F.coalesce("lang", F.lit("")), F.lit(" "))
    source = F.coalesce("source", F.lit(""))
    size = n + F.char_length(lang)
    removed = F.floor(size * 0.55) - F.floor(size * 0.45)
    final = size - removed + F.char_length(source)
    edits = F.array(
        token_edits.edit(F.lit(0), F.lit(0), lang),
        token_edits.edit(F.floor(size * 0.45), F.floor(size * 0.55), source),
        token_edits.edit(F.floor(final * 0.95), final, F.lit("")),
    )
    docs = table(spark, folder, "documents").select("doc_id", "text", edits.alias("edits"))
    return token_edits.count_with_edits(docs, COUNT_TOKENIZER).drop("text", "edits", "edited")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of each document and the component of its near-duplicates."""
    groups = simhash.cluster(table(spark, folder, "documents").select("doc_id", "text"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Alignment of two tokenizers on each document, and how usual its links are."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    aligned = token_alignment.align_documents(docs, *ALIGN_TOKENIZERS, public_tokenizers.PATTERN)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    with token_alignment.aligned_rows(docs):
        aligned = written(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
        pairs = written(token_alignment.link_counts(aligned), "link_counts")
    return token_alignment.score_links(aligned, pairs)


def op12_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Size of each document's shingle set, and the component of its near-duplicates."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return bbit_minhash.cluster(docs).withColumn("kept", kept)


def _branched(digests: DataFrame) -> DataFrame:
    """Conversations that take their first turns from the first of their five.

    Every conversation also gets a row without a turn, so that it stays if no turn is left.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    own = F.col("conv_id")
    numbered = digests.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("turn"),
        "digest",
        "size",
        (own - F.pmod(own, F.lit(5))).alias("base"),
        (F.crc32(own.cast("string").cast("binary")) % 9).alias("head"),
    )
    numbered = written(numbered, "numbered_turns")
    convs = numbered.where("turn = 0").select("conv_id", "base", "head")
    first = numbered.where("conv_id = base AND turn < 8").select("base", "turn", "digest", "size")
    columns = ["conv_id", "turn", "digest", "size"]
    taken = convs.join(first, "base").where("turn < head").select(*columns)
    marks = convs.select(
        "conv_id", F.lit(-1).alias("turn"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("size"),
    )
    kept = numbered.where("turn >= head").select(*columns)
    return kept.unionByName(taken).unionByName(marks)


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of conversations that share the heads of others."""
    turns = conversation_trie.turn_digests(table(spark, folder, "conversations"))
    return conversation_trie.trie_nodes(_branched(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_url_filter,
        op3_warc_normalise,
        op4_best_fit_packing,
        op5_decontamination,
        op6_context_tree,
        op7_host_rules,
        op8_ordinal_quality,
        op9_token_edits,
        op10_simhash,
        op11_token_alignment,
        op12_bbit_minhash,
        op13_conversation_trie,
    )
}

"""From raw documents to packed sequences, as stages that each write Parquet.

Every stage is a function of (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result to the shared folder and hands the written table to the next stage. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.llm import host_rules, packing, secret_scan, simhash, winnowing
from dealscope.llm.common import table, written
from dealscope.llm.queries import PACK_TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or come from a rejected host, go."""
    return host_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicate fingerprints, the document with the smallest id stays."""
    return simhash.drop_near_copies(docs, radius=simhash.RADIUS, shingle=simhash.SHINGLE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go."""
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the text; every document stays."""
    clean = secret_scan.redact_secrets(docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast("long"))
    return clean.select(*[f"`{c}`" for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its token ids and its place in a sequence."""
    return packing.pack(docs, PACK_TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", deduplicate),
    ("benchmark_decontamination", decontaminate),
    ("secret_removal", remove_secrets),
    ("best_fit_packing", pack),
]

# The tokenizer and the fingerprints cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

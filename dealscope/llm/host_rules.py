"""Quality rules by document and by host.

Each document is measured against simple rules. Failures are counted by host with map-side
combine, and each host's failure rate is shrunk towards the rate of all hosts with a beta
prior whose mean and strength come from the hosts themselves (method of moments). A host
whose shrunk rate is above ``host_limit`` is rejected with all its documents.

Defined results: null text has no words, so the document fails; a null host is no host, and
its documents are judged on their own; a single host, or hosts that all fail alike, have no
spread to learn from, and the prior then weighs as much as ``weak_prior`` documents;
repeated rows count each; an empty table gives no rows; extra columns pass through, and a
column named like a new one is replaced.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, free_name, small_or_shuffled, texts_of, written

# The base rules.
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Further rules whose failures count for hosts only.
SYMBOLS_PER_WORD = 0.5
DUPLICATE_LINE_SHARE = 0.5
WORD_LENGTH = (2.0, 15.0)

HOST_LIMIT = 0.7

FEATURES = (
    T.StructType()
    .add("n_words", "long")
    .add("word_chars", "long")
    .add("n_symbols", "long")
    .add("n_dup_lines", "long")
    .add("n_repeat_words", "long")
    .add("base_failed", "boolean")
    .add("rule_failed", "boolean")
)


def repeat_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of consecutive words which the text holds twice or more."""
    if len(words) <= window:
        return 0
    seen = list(zip(*(words[i:] for i in range(window)), strict=False))
    counts = Counter(seen)
    if len(counts) == len(seen):
        return 0
    total = end = 0
    for at, gram in enumerate(seen):
        if counts[gram] > 1:
            total += at + window - max(at, end)
            end = at + window
    return total


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def measure(text: str) -> tuple:
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines, repeated_lines = duplicate_lines(text)
    repeated = repeat_words(words)
    base = n < MIN_WORDS or 100 * repeated > REPEAT_PERCENT * n
    failed = (
        base
        or symbols > SYMBOLS_PER_WORD * n
        or repeated_lines > DUPLICATE_LINE_SHARE * lines
        or not WORD_LENGTH[0] <= chars / n <= WORD_LENGTH[1]
    )
    return n, chars, symbols, repeated_lines, repeated, base, failed


def measure_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of each document, ``base_failed`` and ``rule_failed``."""

    def compute():
        def step(columns: list[pa.Array]) -> list:
            rows = [measure(x) for x in texts_of(columns[0])]
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * len(FEATURES)

        return step

    return append_columns(docs, [text], FEATURES, compute)


def host_verdicts(
    measured: DataFrame,
    host: str = "source",
    host_limit: float = HOST_LIMIT,
    weak_prior: float = 2.0,
) -> DataFrame:
    """(host, n_docs, n_failed, rate, shrunk_rate, rejected), a row per host.

    Hosts are weighed by their documents. With weights w and rates p, the variance between
    hosts is what remains of the weighted variance of p once the binomial part is taken off;
    the prior's strength is m(1-m)/variance - 1. Sums alone are needed, so the prior is one
    aggregate row.
    """
    hosts = written(
        measured.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("n_docs"), F.count_if("rule_failed").alias("n_failed")),
        "hosts",
    )
    k, n, f, nn, fp = hosts.agg(
        F.count("*"),
        F.sum("n_docs"),
        F.sum("n_failed"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")),
        F.sum(F.col("n_failed").cast("double") * F.col("n_failed") / F.col("n_docs")),
    ).first()
    alpha, beta = beta_prior(k, n, f, nn, fp, weak_prior)
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    return hosts.select(
        "host",
        "n_docs",
        "n_failed",
        (F.col("n_failed") / F.col("n_docs")).alias("rate"),
        shrunk.alias("shrunk_rate"),
        (shrunk > host_limit).alias("rejected"),
    )


def beta_prior(
    k: int, n: int | None, f: int | None, nn: float | None, fp: float | None, weak_prior: float
) -> tuple[float, float]:
    """Parameters of the prior from k hosts: documents, failures, and two weighted sums."""
    if not k:
        return weak_prior / 2, weak_prior / 2
    mean = f / n
    spread = mean * (1 - mean)
    strength = weak_prior
    if k > 1 and spread > 0:
        between = fp - n * mean * mean
        variance = (between - (k - 1) * spread) / (n - nn / n - (k - 1))
        if n - nn / n > k - 1 and 0 < variance < spread:
            strength = spread / variance - 1
        elif variance <= 0 or n - nn / n <= k - 1:
            strength = float(n)  # no spread beyond chance: hosts are alike
    strength = max(strength, weak_prior)
    return mean * strength, (1 - mean) * strength


def judge_documents(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    host_limit: float = HOST_LIMIT,
    hosts: DataFrame | None = None,
) -> DataFrame:
    """Add the measures and ``kept``: not failed itself, nor from a rejected host."""
    measured = measure_documents(docs, text)
    verdicts = host_verdicts(measured, host, host_limit) if hosts is None else hosts
    rejected = written(verdicts.where("rejected").select("host"), "rejected_hosts")
    key, flag = free_name(measured, "rejected_host"), free_name(measured, "host_rejected")
    rejected = rejected.select(F.col("host").alias(key), F.lit(True).alias(flag))
    joined = measured.join(
        small_or_shuffled(rejected), measured[host] == rejected[key], "left"
    )
    kept = ~F.col("base_failed") & F.col(flag).isNull()
    return joined.withColumn("kept", kept).drop(key, flag)


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns, also those named like a measure."""
    measures = {f.name.lower() for f in FEATURES} | {"kept"}
    inside = {
        c: free_name(docs, f"input_{c}") if c.lower() in measures else c for c in docs.columns
    }
    renamed = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in inside.items()])
    marked = judge_documents(renamed, inside.get(text, text), inside.get(host, host))
    kept = marked.where("kept")
    return kept.select(*[F.col(f"`{name}`").alias(c) for c, name in inside.items()])

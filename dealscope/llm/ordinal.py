"""Ordinal quality classifier: cumulative-link regression on graded ratings.

A document has one score, the sum of the weights of its hashed text features; ordered
thresholds cut the line of scores into grades, P(grade <= j) = sigmoid(threshold_j - score).
Expected grade and the probability of the upper grades come from the same score.

Grades: 0 toxic, 1 poor, 2 good. The model is fitted on at most ``SAMPLE`` rated documents,
those with the smallest hash of their id; counting and scoring cover every document.

Defined results: null text has no words and is scored by its document features alone; rated
ids without a document, and ratings with a null quality, are not learned from; a null toxic
rating counts as 0; an id that is rated several times takes its lowest grade; of documents
that repeat a rated id, the text of least hash is learned from; without any
rating all grades are equally likely; repeated rows are scored each; an empty table gives no
rows; extra columns pass through, and a column named like a new one is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, bytes_of

GRADES = 3
DIMENSIONS = 1 << 18
SAMPLE = 20_000
# A feature that fewer sampled documents have is noise and gets no weight.
LEAST_DOCUMENTS = 5
_STEPS, _RATE, _DECAY = 150, 0.05, 1e-3

_CLASSES = bytes.maketrans(
    b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    b"x" * 26 + b"X" * 26 + b"9" * 10,
)
_REPEATS = re.compile(rb"([x\x80-\xff])[x\x80-\xff]+|X+|9+")
_PUNCTUATION = b".,;:!?\"'()[]{}|*#"


class Features(dict):
    """Hashed features of a token: its plain form and its shape. Emptied when full."""

    LIMIT = 1_000_000

    def __missing__(self, token: bytes) -> tuple[int, int]:
        plain = token.lower().strip(_PUNCTUATION)
        shape = _REPEATS.sub(lambda m: m.group()[:1], token.translate(_CLASSES))[:8]
        found = (
            zlib.crc32(b"w" + plain) % DIMENSIONS,
            zlib.crc32(b"s" + shape) % DIMENSIONS,
        )
        if len(self) >= self.LIMIT:
            self.clear()
        self[token] = found
        return found

    def of(self, text: bytes) -> np.ndarray:
        """Distinct features of a text."""
        tokens = text.split()
        distinct = set(tokens)
        ids = set()
        for token in distinct:
            ids.update(self[token])
        n = len(tokens)
        for name, value in (
            ("length", n.bit_length()),
            ("distinct", 10 * len(distinct) // n if n else -1),
            ("mean", min(20, len(text) // n) if n else -1),
        ):
            ids.add(zlib.crc32(f"d{name}{value}".encode()) % DIMENSIONS)
        return np.fromiter(sorted(ids), np.int32, len(ids))


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade) of each score, a column per grade."""
        upto = _sigmoid(self.thresholds[None, :] - score[:, None])
        edges = np.concatenate([np.zeros((len(score), 1)), upto, np.ones((len(score), 1))], 1)
        return np.diff(edges, axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray) -> Ordinal:
    """Maximum likelihood with a small penalty, by full-batch Adam steps."""
    n = len(rows)
    if not n:
        share = np.arange(1, GRADES) / GRADES
        return Ordinal(np.zeros(DIMENSIONS), np.log(share / (1 - share)))
    flat = np.concatenate(rows)
    sizes = np.fromiter(map(len, rows), np.int64, n)
    frequent = np.bincount(flat, minlength=DIMENSIONS) >= LEAST_DOCUMENTS
    columns = np.flatnonzero(frequent)
    number = np.full(DIMENSIONS, -1)
    number[columns] = np.arange(len(columns))
    doc = np.repeat(np.arange(n), sizes)[frequent[flat]]
    at = number[flat[frequent[flat]]]
    k = len(columns)

    below = (np.bincount(grades, minlength=GRADES).cumsum()[:-1] + 1) / (n + GRADES)
    first = np.log(below / (1 - below))
    # Parameters: weights, the first threshold, logs of the steps between thresholds.
    x = np.concatenate([np.zeros(k), first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    mean, square = np.zeros_like(x), np.zeros_like(x)
    who = np.arange(n)
    for step in range(1, _STEPS + 1):
        theta = np.concatenate([x[k : k + 1], x[k] + np.cumsum(np.exp(x[k + 1 :]))])
        score = np.bincount(doc, x[at], n)
        upto = np.concatenate(
            [np.zeros((n, 1)), _sigmoid(theta[None, :] - score[:, None]), np.ones((n, 1))], 1
        )
        low, high = upto[who, grades], upto[who, grades + 1]
        p = np.maximum(high - low, 1e-12)
        slope = 1 - low - high  # of the loss, by the score
        by_theta = np.zeros(GRADES - 1)
        above = np.where(grades < GRADES - 1, high * (1 - high) / p, 0)
        under = np.where(grades > 0, low * (1 - low) / p, 0)
        np.add.at(by_theta, np.minimum(grades, GRADES - 2), -above)
        np.add.at(by_theta, np.maximum(grades - 1, 0), under)
        steps = np.cumsum(by_theta[::-1])[::-1]
        gradient = np.concatenate(
            [
                np.bincount(at, slope[doc], k) / n + _DECAY * x[:k],
                steps[:1] / n,
                steps[1:] * np.exp(x[k + 1 :]) / n,
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient * gradient
        change = mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        x -= _RATE * change
    weights = np.zeros(DIMENSIONS)
    weights[columns] = x[:k]
    theta = np.concatenate([x[k : k + 1], x[k] + np.cumsum(np.exp(x[k + 1 :]))])
    return Ordinal(weights, theta)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the ratings."""
    toxic = F.coalesce("toxic", F.lit(0)) > 0
    grade = F.when(toxic, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(grade).alias("grade"))
    )


def train(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE) -> Ordinal:
    """Fit on the documents of at most ``sample`` rated ids."""
    chosen = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rated = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    # A row per id, so that what is collected is bounded by the sample.
    rated = rated.groupBy("doc_id", "grade").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            made = [features.of(x).tobytes() for x in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.binary())], names=["grade", "ids"]
            )

    rows = rated.select("grade", "text").mapInArrow(run, "grade int, ids binary").toArrow()
    ids = [np.frombuffer(x, np.int32) for x in rows.column("ids").to_pylist()]
    return fit(ids, rows.column("grade").to_numpy().astype(np.int64))


def rate_documents(
    docs: DataFrame, model: Ordinal, text: str = "text", least_tail: float = 0.5
) -> DataFrame:
    """Add the expected grade, P(highest grade), and ``kept``: that is ``least_tail`` or more."""
    new = (
        T.StructType()
        .add("expected_grade", "double")
        .add("tail_probability", "double")
        .add("kept", "boolean")
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers

    def compute():
        features, ordinal = Features(), shared.value

        def step(columns: list[pa.Array]) -> list:
            score = np.array(
                [ordinal.weights[features.of(x)].sum() for x in bytes_of(columns[0])], np.float64
            )
            p = ordinal.probabilities(score)
            tail = p[:, -1]
            return [p @ np.arange(GRADES), tail, tail >= least_tail]

        return step

    return append_columns(docs, [text], new, compute)

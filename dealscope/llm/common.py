"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealscope.session import fresh_path

# A side with at most so many rows may be broadcast; the rows hold keys and numbers only.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends at committed files."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast of ``df`` if a count proves it small; else leave it to a shuffle join."""
    rows = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for what is run inside; the setting is restored."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))


def texts_of(column: pa.Array) -> list[str]:
    """Strings of an Arrow column; null becomes the empty string."""
    return [x or "" for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null becomes the empty string."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {chr(b): b for b in plain}
    others = [b for b in range(256) if chr(b) not in symbols]
    return symbols | {chr(256 + k): b for k, b in enumerate(others)}


def by_size(texts: list[bytes], most: int) -> Iterator[list[bytes]]:
    """Groups of about ``most`` bytes, in order; a longer text is a group of its own."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > most:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def arrow_schema(spark_schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark_schema)


def append_columns(
    df: DataFrame,
    reads: list[str],
    new: T.StructType,
    compute: Callable[[], Callable[[list[pa.Array]], list]],
) -> DataFrame:
    """Add columns computed in Arrow batches.

    ``compute()`` runs once per task and returns a function from the arrays of ``reads`` to
    one list (or array) per new column. A column that has a new column's name is replaced,
    by Spark's rule for names.
    """
    names = {f.name.lower() for f in new}
    passed = [f for f in df.schema if f.name.lower() not in names]
    # Plain names inside: a name with a dot would be taken for a field.
    inside = [T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(passed)]
    inputs = [f"input_{i}" for i in range(len(reads))]
    source = df.select(
        *[F.col(f"`{f.name}`").alias(i.name) for f, i in zip(passed, inside, strict=True)],
        *[F.col(f"`{c}`").alias(i) for c, i in zip(reads, inputs, strict=True)],
    )
    made = [T.StructField(f"made_{i}", f.dataType, f.nullable) for i, f in enumerate(new)]
    schema = T.StructType([*inside, *made])
    n = len(passed)
    types = [f.type for f in arrow_schema(new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = compute()
        for batch in batches:
            values = step([batch.column(n + i) for i in range(len(inputs))])
            made = [
                v if isinstance(v, pa.Array) else pa.array(v, t)
                for v, t in zip(values, types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *made], names=[f.name for f in schema]
            )

    names = [f.name for f in [*passed, *new]]
    return source.mapInArrow(run, schema).toDF(*names)


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64, copy=False))

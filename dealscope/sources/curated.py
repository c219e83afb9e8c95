"""Curated Parquet tables: scans and the sinks of the sync jobs."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealscope.functions.parsing import partition_date

COMPRESSION = "snappy"

# Rows of a file that is written alone; a partition with more is split into several.
ROWS_PER_FILE = 2_000_000
# Tasks of a write for each core, if there are as many partition values.
_TASKS_PER_CORE = 2


def read_curated(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """Scan a Parquet dataset with Hive-style partitions; None when it cannot be read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def laid_out_by(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together before a write, splitting the large ones.

    Without it each task writes a file into each partition; a plain repartition would
    give one task a hot partition whole. The rebalance follows the measured sizes.
    """
    return df.hint("rebalance", *partition_cols)


def dealt_by_size(
    df: DataFrame, partition_cols: Sequence[str], rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Rows of a stored frame dealt to the tasks of a write, by the counts of the partitions.

    Small partitions are written several to a task, by as many tasks as the cluster can run
    at once: creating their files takes longer than their rows. A partition with more rows
    than a file should have is dealt to several tasks.
    """
    cols = list(partition_cols)
    sizes = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    values, rows, largest = sizes.agg(F.count(F.lit(1)), F.sum("_n"), F.max("_n")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(values, _TASKS_PER_CORE * cores), math.ceil((rows or 0) / rows_per_file))
    if (largest or 0) <= rows_per_file:
        return df.repartition(tasks, *cols)
    # At most one row for each full file, so it is broadcast: a join by shuffle would bring the
    # large partitions together again, each to one task.
    large = sizes.where(F.col("_n") > rows_per_file).select(
        *[F.col(c).alias(f"_{c}") for c in cols], F.ceil(F.col("_n") / rows_per_file).alias("_n")
    )
    same = [df[c].eqNullSafe(large[f"_{c}"]) for c in cols]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns]), F.col("_n"))
    # The parts of a partition go to tasks in a row: hashed, several could meet in one.
    first = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(tasks))
    task = F.pmod(first + F.coalesce(salt, F.lit(0)), F.lit(tasks)).cast("int")
    salted = df.join(F.broadcast(large), reduce(Column.__and__, same), "left")
    return salted.repartitionById(tasks, task).select(*[f"`{c}`" for c in df.columns])


def append_snapshot(df: DataFrame, path: str, dt: str | None = None) -> int:
    """Append rows into one partition, by default that of the current UTC date.

    The frame is computed once. Returns the number of rows written; an empty frame adds no
    file.
    """
    day = partition_date(F.current_timestamp()) if dt is None else F.lit(dt)
    written = Observation()
    dated = df.withColumn("dt", day)
    _update_records(dated, path)
    (
        dated.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .option("compression", COMPRESSION)
        .partitionBy("dt")
        .parquet(path)
    )
    return written.get["rows"]


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = ("dt",),
    stored: bool = False,
    keep_locations: bool = False,
) -> None:
    """Replace the partitions that occur in the frame; the others stay.

    A ``stored`` frame may be read twice, so its partitions are counted before the write.
    """
    _update_records(df, path, keep_locations)
    layout = dealt_by_size if stored else laid_out_by
    (
        layout(df, partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def overwrite_dataset(
    df: DataFrame, path: str, partition_cols: Sequence[str] = ("dt",), stored: bool = False
) -> None:
    """Replace the whole dataset, partitions that no longer occur included."""
    spark = df.sparkSession
    remove(spark, locations_path(path))
    layout = dealt_by_size if stored else laid_out_by
    (
        layout(df, partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", COMPRESSION)
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    record_schema(spark, path, df.schema)


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned dimension (owners, pipeline stages)."""
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def _file(spark: SparkSession, path: str):
    """Hadoop's path and file system of a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, on whatever file system it lies."""
    target, system = _file(spark, path)
    system.delete(target, True)


# --- records kept beside a table ---------------------------------------------------------


def _records(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/table_records/{name}"


def locations_path(path: str) -> str:
    """Table of the partitions that keys lie in; only a merge keeps it up."""
    return f"{_records(path)}/locations"


def _schema_path(path: str) -> str:
    return f"{_records(path)}/schema.json"


def recorded_schema(spark: SparkSession, path: str) -> StructType | None:
    """All columns that the table's files have, as its writers recorded them."""
    target, system = _file(spark, _schema_path(path))
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return StructType.fromJson(json.loads(text))


def record_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Keep the schema beside the table, so that no reader has to merge its footers."""
    target, system = _file(spark, _schema_path(path))
    stream = system.create(target, True)
    try:
        stream.write(bytearray(schema.json().encode()))
    finally:
        stream.close()


def evolved(schema: StructType, more: StructType) -> StructType:
    """``schema`` with the columns of ``more`` that it does not have."""
    return StructType([*schema.fields, *[f for f in more.fields if f.name not in schema.names]])


def _update_records(df: DataFrame, path: str, keep_locations: bool = False) -> None:
    """Before a write of some partitions: new columns are recorded, old locations dropped."""
    spark = df.sparkSession
    known = recorded_schema(spark, path)
    if known is not None and set(df.schema.names) - set(known.names):
        record_schema(spark, path, evolved(known, df.schema))
    if not keep_locations:
        remove(spark, locations_path(path))

"""Session settings the engine relies on, and the shared folder it may write to."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Runtime settings. Landing timestamps are UTC. Adaptive execution splits hot join
# partitions and rebalances writes. The JVM only compiles methods below 8000 bytes, so the
# wide projections of the normalizers run faster as several methods than as one.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Parquet is about a third of the rows' size in a shuffle.
_STORED_BYTES_PER_PARTITION = 64 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(name: str = "dealscope", **settings: str) -> SparkSession:
    """Session with the engine's settings; ``settings`` are further configuration keys."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**REQUIRED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="dealscope-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@lru_cache(maxsize=64)
def _stored_bytes(spark: SparkSession, path: str) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def size_shuffles(spark: SparkSession, path: str) -> None:
    """Start shuffles with as many partitions as the input's stored size calls for.

    Adaptive execution merges small partitions but cannot add any, and the default of 200
    would give each task of a 100 TB shuffle half a terabyte.
    """
    wanted = _stored_bytes(spark, path) // _STORED_BYTES_PER_PARTITION
    partitions = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))


def fresh_path(spark: SparkSession, name: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_folder(spark)}/dealscope/{name}-{uuid.uuid4().hex}"

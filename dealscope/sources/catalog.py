"""Catalog tables over curated datasets."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from dealscope.sources.curated import read_curated


# Partitions added by one statement.
_TOGETHER = 200
_NULL = "__HIVE_DEFAULT_PARTITION__"

Partition = tuple[str | None, ...]


def add_partitions(
    spark: SparkSession, name: str, path: str, partition_cols: tuple[str, ...]
) -> int:
    """Tell the catalog about folders it does not know; how many there were.

    Only the levels of partition folders are listed, no files.
    """
    known = {
        _values(row["partition"]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()
    }
    new = sorted(_folders(spark, path, len(partition_cols)) - known, key=repr)
    for at in range(0, len(new), _TOGETHER):
        specs = " ".join(_spec(partition_cols, p) for p in new[at : at + _TOGETHER])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    return len(new)


def _values(folders: str) -> Partition:
    """Values of ``a=1/b=2``; null for the folder that stands for it."""
    values = [unquote(part.partition("=")[2]) for part in folders.split("/")]
    return tuple(None if v in (_NULL, "null") else v for v in values)


def _folders(spark: SparkSession, path: str, depth: int) -> set[Partition]:
    """Partition values that have a folder below the path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    level = [("", root)]
    for _ in range(depth):
        level = [
            (f"{names}/{entry.getPath().getName()}", entry.getPath())
            for names, folder in level
            for entry in system.listStatus(folder)
            if entry.isDirectory() and "=" in entry.getPath().getName()
        ]
    return {_values(names.strip("/")) for names, _ in level}


def _spec(partition_cols: tuple[str, ...], values: Partition) -> str:
    def text(value: str | None) -> str:
        return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = ", ".join(f"`{c}` = {text(v)}" for c, v in zip(partition_cols, values, strict=True))
    return f"PARTITION ({pairs})"


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType | None = None,
    partition_cols: tuple[str, ...] = ("dt",),
) -> DataFrame:
    """Make a curated dataset queryable by name, and take up new columns and partitions.

    The first call creates an external table. Later ones add the columns that have come
    and the partitions whose folders the catalog does not know yet; columns and partitions
    are never dropped.
    """
    if schema is None:
        found = read_curated(spark, path)
        if found is None:
            raise ValueError(f"no dataset to register at {path}")
        schema = found.schema
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        partitioning = f"PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioning} LOCATION '{path}'")
    else:
        known = set(spark.table(name).columns)
        added = [f for f in schema.fields if f.name not in known]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    if partition_cols:
        add_partitions(spark, name, path, partition_cols)
    spark.catalog.refreshTable(name)
    return spark.table(name)

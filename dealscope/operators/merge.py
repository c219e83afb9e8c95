"""Merge-upsert into a date-partitioned Parquet table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import islice
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealscope.operators.dedupe import any_order, latest_per_key
from dealscope.sources.curated import (
    COMPRESSION,
    locations_path,
    overwrite_dataset,
    overwrite_partitions,
    record_schema,
    recorded_schema,
    remove,
)

# Partition values up to which they are broadcast; more are shuffled.
_BROADCAST_PARTITIONS = 100_000
# Folders that are removed at once.
_REMOVERS = 16

# What a merge is about to change: rows of the affected partitions before (None if the table
# is new) and after it, both stored, and the affected partitions' values.
OnChange = Callable[[DataFrame | None, DataFrame, DataFrame], None]


def full_load(
    df: DataFrame, path: str, partition_cols: Sequence[str] = ("dt",), staged: bool = False
) -> None:
    """Full sync: the frame becomes the whole table.

    It is written to ``<path>_incoming`` first, unless it is ``staged`` already, so a run
    that fails while the table is replaced can be repeated from there.
    """
    rows = df if staged else stage(df, f"{path}_incoming")
    overwrite_dataset(rows, path, partition_cols, stored=True)
    if not staged:
        remove(df.sparkSession, f"{path}_incoming")


def merge_upsert(
    df: DataFrame,
    path: str,
    primary_key: str | Sequence[str],
    partition_cols: Sequence[str] = ("dt",),
    latest_first: Sequence[Column] = (),
    global_key: bool = False,
    staged: bool = False,
    incoming_first: bool = True,
    on_change: OnChange | None = None,
) -> None:
    """Merge incoming rows into the partitions they belong to.

    Of the affected partitions' old rows and the incoming ones, each key keeps one row:
    an incoming one before an old one unless ``incoming_first`` is off, then by
    ``latest_first``, then by a hash of the row, so that ties fall alike in every run. Only
    affected partitions are written, and by partition pruning only they are read, however
    many there are. With ``global_key`` those holding an older copy of an incoming key count
    as affected too, so a row that moved to another partition leaves no copy. They are found
    in a table of key hashes and partitions, which the first such merge makes and each one
    adds to before it changes the table: it may name a partition that a key has left, but
    misses none. ``on_change`` is called before the table is replaced, and again if the run is.

    The result is written to ``<path>_staging`` first. The table is then replaced from that
    copy, so a run that fails half-way can be repeated without loss. Copies are removed at
    the end; a frame that is ``staged`` is read as it is and left to the caller.
    """
    spark = df.sparkSession
    partition_cols = list(partition_cols)
    keys = [primary_key] if isinstance(primary_key, str) else list(primary_key)
    incoming = df if staged else stage(df, f"{path}_incoming")
    affected = incoming.select(*partition_cols).distinct()
    existing = _read_existing(spark, path, incoming.schema, partition_cols)
    old = None
    if existing is not None:
        for name in set(keys) - set(existing.columns):  # a key column that came later
            existing = existing.withColumn(name, F.lit(None).cast(incoming.schema[name].dataType))
    if existing is None:
        merged = incoming.withColumn("_incoming", F.lit(1))
    else:
        if global_key:
            locations = _locations(existing, path, keys, partition_cols)
            holding = _partitions_with_keys(locations, incoming, keys, partition_cols)
            _add_locations(locations, incoming, path, keys, partition_cols)
            affected = stage(affected.union(holding).distinct(), f"{path}_affected")
        old = _in_partitions(existing, affected, partition_cols)
        merged = old.withColumn("_incoming", F.lit(0)).unionByName(
            incoming.withColumn("_incoming", F.lit(1)), allowMissingColumns=True
        )
    tie = any_order([c for c in merged.columns if c != "_incoming"])
    order = [*latest_first, tie]
    if incoming_first:
        order = [F.col("_incoming").desc(), *order]
    result = stage(latest_per_key(merged, keys, order).drop("_incoming"), f"{path}_staging")
    if on_change is not None:
        on_change(old, result, affected)
    emptied = None
    if existing is not None and global_key:
        emptied = stage(
            _emptied_folders(existing, affected, result, partition_cols), f"{path}_emptied"
        )
    if existing is None:
        remove(spark, locations_path(path))
        record_schema(spark, path, result.schema)
    overwrite_partitions(result, path, partition_cols, True, True)
    # A dynamic overwrite leaves partitions without new rows as they are; the folders of
    # those whose rows have all moved are removed.
    if emptied is not None:
        _remove_all(spark, emptied)
    for copy in ("incoming", "staging", "affected", "emptied"):
        if not (staged and copy == "incoming"):
            remove(spark, f"{path}_{copy}")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write to a folder beside the table, replacing an earlier run's, and read it back.

    The copy is not partitioned, so it is written where its rows are, without a shuffle.
    """
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _read_existing(
    spark: SparkSession, path: str, incoming: StructType, partition_cols: list[str]
) -> DataFrame | None:
    """Old rows of the table, with every column their files have, by the recorded schema.

    Only a table that has none has its footers merged, once. Partition columns get the
    incoming types instead of types guessed from folder names.
    """
    known = recorded_schema(spark, path)
    try:
        if known is None:
            known = spark.read.option("mergeSchema", True).parquet(path).schema
            record_schema(spark, path, known)
        inside = [f for f in known.fields if f.name not in partition_cols]
        fields = [*inside, *[incoming[c] for c in partition_cols]]
        return spark.read.schema(StructType(fields)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _located(rows: DataFrame, keys: list[str], partition_cols: list[str]) -> DataFrame:
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    return rows.select(hashed.alias("key_hash"), *partition_cols)


def _locations(
    existing: DataFrame, path: str, keys: list[str], partition_cols: list[str]
) -> DataFrame:
    """(key_hash, partition columns) of the table's rows, made from it if it is missing."""
    spark = existing.sparkSession
    place = locations_path(path)
    made = _located(existing, keys, partition_cols)
    try:
        return spark.read.schema(made.schema).parquet(place)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return stage(made, place)


def _partitions_with_keys(
    locations: DataFrame, incoming: DataFrame, keys: list[str], partition_cols: list[str]
) -> DataFrame:
    """Partitions that hold a key of the incoming rows, and maybe some that held one."""
    wanted = _located(incoming, keys, []).distinct()
    return locations.join(wanted, "key_hash", "left_semi").select(*partition_cols)


def _add_locations(
    locations: DataFrame,
    incoming: DataFrame,
    path: str,
    keys: list[str],
    partition_cols: list[str],
) -> None:
    """Add the incoming rows' places to the table of locations, those it does not have."""
    new = _located(incoming, keys, partition_cols).distinct().alias("new")
    known = locations.alias("known")
    same = [
        F.col(f"new.{c}").eqNullSafe(F.col(f"known.{c}")) for c in ["key_hash", *partition_cols]
    ]
    missing = new.join(known, reduce(Column.__and__, same), "left_anti")
    copy = f"{locations_path(path)}_new"
    # Staged, so that the table is not read while it is appended to.
    stage(missing, copy).write.mode("append").option("compression", COMPRESSION).parquet(
        locations_path(path)
    )
    remove(locations.sparkSession, copy)


def _in_partitions(
    existing: DataFrame, affected: DataFrame, partition_cols: list[str]
) -> DataFrame:
    """Rows of the affected partitions, by a semi-join that prunes at run time.

    Plain equality is what partition pruning knows, so null partitions are joined apart.
    """
    named = reduce(Column.__and__, [F.col(c).isNotNull() for c in partition_cols])
    wanted = affected.select(*partition_cols)
    counted = wanted.limit(_BROADCAST_PARTITIONS + 1).agg(
        F.count(F.lit(1)), F.count_if(~named)
    )
    values, nulls = counted.first()
    if values <= _BROADCAST_PARTITIONS:
        wanted = F.broadcast(wanted)
    plain = existing.filter(named).join(wanted.filter(named), partition_cols, "left_semi")
    if values <= _BROADCAST_PARTITIONS and not nulls:
        return plain
    others = wanted.filter(~named)
    some_null = existing.filter(~named)
    same = reduce(
        Column.__and__, [some_null[c].eqNullSafe(others[c]) for c in partition_cols]
    )
    return plain.unionByName(some_null.join(others, same, "left_semi"))


def _emptied_folders(
    existing: DataFrame, affected: DataFrame, staged: DataFrame, partition_cols: list[str]
) -> DataFrame:
    """Folders of the affected partitions that have no row any more, one per partition value."""
    kept = staged.select(*partition_cols).distinct()
    same = [affected[c].eqNullSafe(kept[c]) for c in partition_cols]
    emptied = affected.join(kept, reduce(Column.__and__, same), "left_anti")
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    located = existing.select(*partition_cols, folder.alias("folder"))
    return _in_partitions(located, emptied, partition_cols).select("folder").distinct()


def _remove_all(spark: SparkSession, folders: DataFrame) -> None:
    """Delete folders, many at a time; their names pass through the driver in small parts."""
    names = (unquote(row["folder"]) for row in folders.toLocalIterator())
    with ThreadPoolExecutor(_REMOVERS) as pool:
        while some := list(islice(names, 1000)):
            list(pool.map(lambda folder: remove(spark, folder), some))

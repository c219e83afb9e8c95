"""Comparison of a Spark result with DuckDB SQL over the same Parquet tables."""

from __future__ import annotations

import glob
import os
from datetime import datetime
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, Decimal):
        return value.normalize()
    return value


def sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Rows with columns by name, in an order of their own."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return sorted_rows(df.columns, df.collect())


def duck_rows(db, sql: str):
    found = db.execute(sql)
    return sorted_rows([c[0] for c in found.description], found.fetchall())

"""Every registered query against DuckDB over the smallest test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from queries import QUERIES

from .compare import connect, duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_each_statement_has_a_query():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_flagship_query(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_duckdb(spark, db, name):
    found = spark_rows(queries()[name](spark, FOLDER))
    expected = duck_rows(db, oracle_sql()[name])
    assert found[0] == expected[0]
    assert found[1] == expected[1]

"""Every query against its SQL in DuckDB at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from tallyhouse.checks.queries import all_queries
from tallyhouse.sources.derived import BASE_TABLES

FOLDER = "/root/testdata/sf0.001"
KEYS = sorted(all_queries())


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(KEYS) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, duck, key):
    df = entry_point.queries()[key](spark, FOLDER)
    columns = sorted(df.columns)
    relation = duck.sql(entry_point.oracle_sql()[key])
    assert columns == sorted(relation.columns)
    mine = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    theirs = sorted(repr(r) for r in relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert mine == theirs

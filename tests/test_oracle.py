"""Every registered query against its SQL twin on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from suite.fixtures import TABLES
from tools_check import rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert mine[1]
        return
    result = duck.execute(ORACLES[name])
    assert mine == rows_of([d[0] for d in result.description], result.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3

"""Every named query at the smallest scale: equal to its SQL, or at least not empty."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_queries import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection: duckdb.DuckDBPyConnection, name):
    ours = queries()[name](spark, FOLDER).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(ours)
    else:
        assert difference(ours, connection.execute(sql).df()) is None

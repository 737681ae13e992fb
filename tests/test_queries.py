"""Every query with SQL is compared with it; the others must return rows."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SF_DIR

SQL = entry.oracle_sql()
QUERIES = entry.queries()
HEAVY = {"experiment_grid", "sweep", "stream_medallion", "stream_resume", "time_dim"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - HEAVY))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL.get(name), SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0

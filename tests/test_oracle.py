"""Every registered query runs; those with a SQL twin give the twin's rows."""

import os

import pytest
from oracle_check import compare, connect

from claimworks import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0

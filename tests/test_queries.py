"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry

from .oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_sql_belongs_to_queries():
    assert SQL.keys() <= QUERIES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert differences(con, df, SQL[name]) == []
    else:
        df.count()

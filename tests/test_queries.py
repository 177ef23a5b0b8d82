"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con, data):
    ok, message, rows, _, _ = compare(spark, con, data, QUERIES[name], SQL.get(name))
    assert ok, message
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1

"""Every query that has SQL must give exactly its rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert difference(entry.queries()[name](spark, SF_DIR), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_query_without_sql(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0

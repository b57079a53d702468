"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import oracle
from checks.compare import connect, difference
from checks.queries import all_queries

SMALL = "/root/testdata/sf0.001"
QUERIES = all_queries()
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SMALL).toPandas()
    assert difference(result, duck.sql(SQL[name]).df()) is None


def test_entry_registers_every_query_here():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 21

"""Every registered query against its SQL on the given tables."""

import oracle_compare
import pytest

import __spark_entry__ as entry

# The operators for training text have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name not in entry.LLM_QUERIES}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name not in entry.LLM_ORACLES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_compare.connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert oracle_compare.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_flagship(spark):
    assert entry.entry(spark).count() == 25

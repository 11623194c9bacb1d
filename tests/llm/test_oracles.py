"""Operators that SQL can express, against their SQL on the whole given tables."""

import oracle_compare
import pytest

from shelfline.llm import oracles, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_compare.connect(sf_dir)


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_query(spark, sf_dir, con, name):
    assert oracle_compare.differences(queries.QUERIES[name](spark, sf_dir), con, oracles.ORACLES[name]) == []

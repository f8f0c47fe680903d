"""Operator queries against their SQL twins on whole tables."""

import pytest

from cartouche.llm.oracle import ORACLES
from cartouche.llm.queries import QUERIES
from compare import connect, difference


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, connection, sf_dir, name):
    assert difference(spark, connection, QUERIES[name], ORACLES[name], sf_dir) is None


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))

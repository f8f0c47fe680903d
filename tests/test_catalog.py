"""Every catalog query against its SQL twin."""

import pytest

from __spark_entry__ import entry
from cartouche.plans.catalog import QUERIES
from cartouche.plans.oracle import ORACLES
from compare import connect, difference


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, connection, sf_dir, name):
    plans = []

    def query(*arguments):
        frame = QUERIES[name](*arguments)
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return frame

    assert difference(spark, connection, query, ORACLES[name], sf_dir) is None
    assert "CartesianProduct" not in plans[0] and "NestedLoop" not in plans[0]


def test_entry(spark):
    assert entry(spark).count() == 3

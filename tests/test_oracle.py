"""Every registered query of the graph engine against its SQL, on the smallest tables."""

import pytest
from oracle import DATA, compare

from graphloom.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    compare(spark, QUERIES[name], ORACLES[name], "sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_runs(spark, name):
    assert QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_registered_once():
    assert len(QUERIES) == sum(len(m.QUERIES) for m in registry.MODULES)
    assert ORACLES.keys() <= QUERIES.keys()

"""Every registered query against its comparison SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from checks import registry
from checks.compare import difference, engine

queries, oracle_sql = registry.QUERIES.copy, registry.ORACLES.copy


@pytest.fixture(scope="module")
def con(sf_dir):
    return engine(sf_dir)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches(spark, sf_dir, con, name):
    assert difference(queries()[name](spark, sf_dir), con, oracle_sql()[name]) is None

"""Every registered query of the library's own operators against its SQL on the smallest data."""

import pytest

import __spark_entry__ as registered
from oracle_check import difference, duck
from tidemark.plans import oracles, queries

NAMES = sorted(queries.ALL)


@pytest.fixture(scope="session")
def con(sf):
    return duck(sf)


def test_each_query_is_registered_with_its_sql():
    assert set(NAMES) == set(oracles.SQL)
    assert set(NAMES) <= set(registered.queries()) and set(NAMES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, sf, con, name):
    assert difference(queries.ALL[name](spark, sf), con, oracles.SQL[name]) is None


def test_entry_has_one_row_per_partition(spark):
    assert registered.entry(spark).count() == 5

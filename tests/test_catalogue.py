"""Every catalogue query equals its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from digestloom.plans.queries import QUERIES
from tests.parity import compare, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0

"""Every named query against its SQL in DuckDB, values compared exactly."""

import pytest
from oracle_check import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from tallyloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
# The queries of the optional package have their own tests.
OWN = [n for n in queries() if n in QUERIES]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    assert differences(spark, con, SF, name) == []


def test_entry(spark):
    assert entry(spark).count() == 6


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())

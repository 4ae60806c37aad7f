"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference

SF = "/root/testdata/sf0.001"
NAMES = list(queries())


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    problem = difference(spark, connection, name, queries()[name], oracle_sql().get(name), SF)
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0

"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check import database, difference
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() <= ORACLES.keys() & contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    actual = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(actual)
    assert difference(actual, con.execute(ORACLES[name]).df()) is None

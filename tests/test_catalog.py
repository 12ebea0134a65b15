"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as driver
from spinneret.plans import catalog
from tests.oracle import compare, connect

ROWS_ONLY = set()


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == ROWS_ONLY
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, small, connection, name):
    df = catalog.QUERIES[name](spark, small)
    if name in ROWS_ONLY:
        assert df.count() > 0
    else:
        assert compare(connection, catalog.ORACLES[name], df) == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0

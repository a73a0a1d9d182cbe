"""Every registered query against the SQL of its rule."""

import pytest
from compare import connect, difference

from arrears_mart.registry.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_driver_contract(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) == set(ORACLES) <= set(driver.oracle_sql())
    assert driver.entry(spark).columns

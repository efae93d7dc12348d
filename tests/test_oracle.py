"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, difference
from tripmart.plans.oracle import all_oracles
from tripmart.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert all_queries().keys() == all_oracles().keys()
    assert all_queries().keys() <= driver.queries().keys()


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", all_queries())
def test_query_matches_sql(spark, duck, name):
    actual = driver.queries()[name](spark, SF_DIR).toArrow()
    expected = duck.sql(driver.oracle_sql()[name]).to_arrow_table()
    assert difference(actual, expected) is None

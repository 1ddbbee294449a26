"""Every registered query against its SQL oracle, over the whole smallest data set."""

import pytest

import __spark_entry__ as driver
from oracle_check import connect, differences

from tickloom.plans.catalog import QUERIES
from tickloom.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_of_the_trade_tape_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", [n for n in driver.queries() if n in driver.oracle_sql()])
def test_query_matches_sql(spark, sql, name):
    result = driver.queries()[name](spark, SF_DIR)
    assert differences(result, sql, driver.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 880

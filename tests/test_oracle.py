"""Every registered query against plain SQL on the same tables."""

import pytest

import __spark_entry__ as driver
from tests.oracle_check import connect, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(driver.queries()))
def test_query_matches_sql(spark, con, key):
    got = spark_rows(driver.queries()[key](spark, SF))
    if key not in driver.oracle_sql():
        assert got[1]
        return
    want = sql_rows(con, driver.oracle_sql()[key])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1]


def test_entry(spark):
    assert driver.entry(spark).count() > 0

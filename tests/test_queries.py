"""Every registered query against its SQL in a second engine."""

import pytest

import __spark_entry__ as driver
from tests.oracle_check import TESTDATA, connection, differences

SF_DIR = str(TESTDATA / "sf0.001")

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["neighborhood", "average_price", "n_listings"]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert differences(df, con, driver.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert driver.queries()[name](spark, SF_DIR).count() > 0

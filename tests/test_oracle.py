"""Every query against its SQL on the given tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import connect, difference

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert driver.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 9

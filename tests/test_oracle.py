"""Every registered query against its SQL on the small test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tallyloom.oracle import ORACLE_SQL
from tallyloom.registry import QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    result = driver.queries()[name](spark, FOLDER)
    assert differences(result, database, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["mes", "ano", "gastos", "codigo"]

"""Every registered query against its SQL in DuckDB, over whole tables."""

import pytest

import __spark_entry__ as driver
from check import compare, connect
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, sf_dir, name):
    assert compare(spark, connection, sf_dir, name) is None


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.columns == ["date", "area", "num_of_eq"]
    assert rows.groupBy().sum("num_of_eq").first()[0] == 1000

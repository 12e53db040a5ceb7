"""Every registered query against its SQL oracle, all values."""

import pytest

import __spark_entry__ as entry_point
from compare import compare, open_duckdb
from tillroll.testbed import oracles
from tillroll.testbed.queries import QUERIES

ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return open_duckdb(small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, small, duck, name):
    assert compare(QUERIES[name](spark, small), duck, ORACLES[name]) == ""


def test_entry_is_the_published_result(spark, small):
    row = entry_point.entry(spark).collect()[0]
    assert row.total_revenue == 66140357.46
    assert (row.total_invoices, row.total_customers) == (1932, 493)

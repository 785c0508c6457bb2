"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as contract
from ledgerloom_checks.compare import compare, duck_tables

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_tables(SMALL)


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "customer_segment" and df.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    assert not compare(QUERIES[name](spark, SMALL), duck, SQL[name])

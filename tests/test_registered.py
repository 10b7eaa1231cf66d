"""The registered queries against their SQL, at the smallest scale factor."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
from harness import oracle
from harness.compare import duckdb_over, result_rows
from harness.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")

# Every query has its SQL.
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def tables():
    return duckdb_over(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(oracle.sql()) == WITHOUT_SQL
    assert set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_the_flagship_query_has_rows(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle.sql()))
def test_results_equal_the_sql(spark, tables, name):
    frame = registered.queries()[name](spark, SF_DIR)
    result = tables.sql(registered.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(result.columns)
    found = result_rows(frame.columns, [tuple(row) for row in frame.collect()])
    assert found == result_rows(result.columns, result.fetchall())

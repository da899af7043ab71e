"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import differences, open_duckdb

import __spark_entry__ as entry
from workload import market_queries, operator_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {**operator_queries.QUERIES, **market_queries.QUERIES}
ORACLES = {**operator_queries.ORACLES, **market_queries.ORACLES}


@pytest.fixture(scope="module")
def duck():
    return open_duckdb(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0

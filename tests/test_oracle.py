"""Every registered query against its DuckDB SQL at sf0.01 (the driver's
correctness gate): same columns, same row count, same rows."""

from __future__ import annotations

import pytest
from conftest import SF001
from oracle_compare import compare, duckdb_connection

import __spark_entry__ as entry_module
from cartwheel.oracle import oracle_sql
from cartwheel.queries import QUERIES


SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF001)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["region", "month", "total_revenue", "order_count", "avg_order_value",
                          "unique_customers", "revenue_tier"]
    assert df.count() > 0

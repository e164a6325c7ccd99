"""The operators' queries against DuckDB, and the registry's completeness."""

from __future__ import annotations

import pytest
from oracle_compare import compare, duckdb_connection

from cartwheel.llm.oracle import ORACLES
from cartwheel.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.01"
#: not expressible in SQL: held against brute force, round trips or held-out accuracy
PLAIN = {"op1_packing", "op2_sentencepiece", "op6_language_id", "op9_fingerprints", "op10_quality_rules"}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF001)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) == set(ORACLES) | PLAIN


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF001)
    assert not problems, problems

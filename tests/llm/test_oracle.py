"""Operators that SQL can express, against DuckDB."""

import pytest
from oracle_compare import compare, duck

from quern.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    r = compare(spark, duck(sf_dir), name, QUERIES[name], ORACLE_SQL[name], sf_dir)
    assert r["columns_match"] and r["types_match"] and r["values_match"], r

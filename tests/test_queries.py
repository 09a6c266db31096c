"""Every registered query against its DuckDB oracle (sf0.001 always; sf0.01 with QUERN_SF001=1)."""

import os

import pytest
from oracle_compare import compare, duck

import __spark_entry__ as entry
from quern.plans import ORACLE_SQL, QUERIES

DIRS = ["/root/testdata/sf0.001"] + (["/root/testdata/sf0.01"] if os.environ.get("QUERN_SF001") else [])


@pytest.fixture(scope="module")
def cons():
    return {d: duck(d) for d in DIRS if os.path.isdir(d)}


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("sf_dir", DIRS)
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, cons, sf_dir, name):
    if sf_dir not in cons:
        pytest.skip("table folder missing")
    r = compare(spark, cons[sf_dir], name, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "cnt"]
    assert df.count() > 0

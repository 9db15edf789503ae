"""Every registered query against its DuckDB oracle (sf0.001), the same
check the driver runs at sf0.01."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

from paths import SF001

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, SF001, QUERIES[key], ORACLES[key], con)
    assert r["match"] and r["types_match"], r


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, key):
    assert QUERIES[key](spark, SF001).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "vwap" in df.columns

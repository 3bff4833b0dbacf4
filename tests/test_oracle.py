"""Every registered query against its DuckDB oracle on the smallest driver tables
(the driver repeats this at sf0.01); rows-only queries must run and be non-empty."""

import pytest

import __spark_entry__ as entry
from claimflow.checks.compare import compare
from places import SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def test_every_query_is_registered_with_a_unique_name():
    assert len(QUERIES) >= 50
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], SF_SMALL)
    assert ok, f"{name}: {msg}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "churn_propensity_score" in df.columns

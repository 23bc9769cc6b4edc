"""Differential test: every registered query vs its DuckDB oracle SQL."""

from __future__ import annotations

import re

import pytest
from check_oracle import compare, duck
from conftest import SMOKE

import __spark_entry__ as entry
from funnel_engine.oracle import oracle_sql

# The queries of the optional training-data subpackage have tests of their own.
QUERIES = {k: f for k, f in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SMOKE).toPandas()
    want = con.execute(SQL[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "churn_risk" in df.columns


@pytest.mark.parametrize("name", ["clean_sessions", "funnel_summary", "customer_retention_churn", "run_summary", "monthly_long"])
def test_arrow_schema_matches_oracle(spark, con, name):
    got = {f.name: str(f.type) for f in QUERIES[name](spark, SMOKE).toArrow().schema}
    want = {f.name: str(f.type) for f in con.sql(SQL[name]).to_arrow_table().schema}
    assert got == want

"""Every registered query against its DuckDB twin (sf0.001), a core set at sf0.01."""

from __future__ import annotations

import pytest
from oracle_compare import compare
from paths import SF_ORACLE, SF_SMALL

import __spark_entry__ as entry

from ontime.plans.registry import all_queries, all_sql

SQL = all_sql()
QUERIES = all_queries()

# Queries whose sf0.01 result the fixture facts pin down (FIXTURES F5).
CORE = ["bucket_summary", "tidy_profile", "cleaning_report", "missing_report", "delay_rate_grouping_sets",
        "quantiles_exact", "correlation_matrix", "hash_split", "kde_grid", "histogram_80", "dim_enrich"]


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["delay_bucket", "n", "pct"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb_small(spark, duck_small, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), duck_small, SQL[name])
    assert ok, msg


@pytest.mark.parametrize("name", CORE)
def test_query_matches_duckdb_sf001(spark, duck_oracle, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), duck_oracle, SQL[name])
    assert ok, msg


def test_fixture_facts_sf001(spark):
    """Bucket counts, quartile and stddev stated in FIXTURES F5."""
    from ontime.plans.registry import clean
    from ontime.operators import rates, profile

    got = {r["delay_bucket"]: r["n"] for r in rates.bucket_summary(clean(spark, SF_ORACLE)).collect()}
    assert got == {"<= -15": 7021, "(-15,0]": 17353, "(0,15)": 16165, ">= 15": 17151}
    prof = {r["metric"]: r["value"] for r in profile.tidy_profile(clean(spark, SF_ORACLE), "ArrDelay").collect()}
    assert prof["q1 (25%)"] == -8 and prof["q95"] == 28
    assert abs(prof["stddev"] - 14.854836276980759) < 1e-9

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry
from catalog import QUERIES
from conftest import SF_SMALL
from oracle import statements
from tools.compare import compare, oracle_connection

COMPARED = [
    "mart_monthly_revenue", "mart_driver_performance", "mart_rider_activity", "mart_churn_summary", "mart_completion_summary",
    "dedup_latest", "flag_primary", "gap_drivers", "dq_report", "dq_report_rides", "dq_report_learning", "fx_asof", "profile_table", "stream_daily_usage", "ledger_tie_out", "run_trend",
    "flag_validity", "fraud_reversals", "restatement_bridge", "ledger_match_lines", "trailing_active_riders", "robust_gap_trend", "fx_restated",
    "profile_merged", "stream_first_rows", "stream_arrival_counts", "stream_uncaptured",
]


@pytest.fixture(scope="module")
def oracle() -> duckdb.DuckDBPyConnection:
    return oracle_connection(SF_SMALL)


def test_every_query_has_a_statement_that_runs(oracle):
    known = statements()
    assert set(known) == set(QUERIES) and len(known) > 100
    for name, sql in known.items():
        assert oracle.execute(f"DESCRIBE {sql}").fetchall(), name


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_statement(spark, oracle, name):
    assert compare(QUERIES[name](spark, SF_SMALL), oracle, statements()[name]) == ""


def test_entry_is_lazy_and_has_rows(spark):
    df = entry(spark)
    assert df.columns[0] == "report_month" and df.count() > 0

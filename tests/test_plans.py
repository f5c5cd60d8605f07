"""Plan properties that must hold whatever the size of the input."""

from __future__ import annotations

import re

import pytest

from catalog import QUERIES
from conftest import SF_SMALL

# Windows over raw rows are limited to one row per key before the exchange; the others
# hold finished bridges (months, lines), runs, rate quotes, payouts summed per trip and driver, the days of a block of bitmaps, one
# of 256 parts of the lines of a key, amount and day, or the buckets of a column's sketch.
WINDOWS = {
    "stg_03_usage": "WindowGroupLimit", "stg_03_payments": "WindowGroupLimit", "dedup_priority": "WindowGroupLimit",
    "dedup_business_key": "WindowGroupLimit", "usage_window_30d": "WindowGroupLimit", "dq_report_telecom": "WindowGroupLimit",
    "gap_drivers": "report_month", "gap_trend": "report_month", "fx_asof": "currency", "run_trend": "ended_at", "robust_gap_trend": "report_month",
    "fx_restated": "currency", "trailing_active_riders": "block", "ledger_match_lines": "part", "ledger_match": "part",
    "profile_merged": "column_name",
    "mart_driver_performance": "trip_id", "driver_incentives": "trip_id",
}


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return {
            name: query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            for name, query in QUERIES.items() if not name.startswith("stream_")
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _hash_exchanges(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def test_no_query_pairs_all_rows(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_windows_never_hold_the_raw_rows_of_a_key(plans):
    assert {name for name, plan in plans.items() if re.search(r"[-+] Window \[", plan)} == set(WINDOWS)
    for name, plan in plans.items():
        if re.search(r"[-+] Window \[", plan):
            assert name in WINDOWS and WINDOWS[name] in plan, name
        for line in plan.splitlines():
            if re.search(r"[-+] Window \[", line):
                assert WINDOWS[name] != "WindowGroupLimit" or "row_number()" in line, (name, line)


def test_only_finished_months_meet_in_one_task(plans):
    for name, plan in plans.items():
        parts = plan.split("Exchange SinglePartition")
        for below in parts[1:]:
            node = below.splitlines()[1] if len(below.splitlines()) > 1 else ""
            # What reaches a single task is a partial one-row aggregate, or the months of a bridge.
            assert re.search(r"Aggregate\(keys=\[\]|SortAggregate\(key=\[\]", node) or name in ("gap_trend", "run_trend", "robust_gap_trend"), (name, node)


@pytest.mark.parametrize(("name", "exchanges"), [
    ("int_orders_enriched", 4),       # orders, payments, refunds, shipping
    ("int_trips_enriched", 3),        # trips, payments, incentives
    ("int_subscriber_signals", 5),    # lines, usage by business key and by line, payments, tickets
    ("payment_rollup", 1), ("lesson_rollup", 2), ("dedup_latest", 1), ("stg_03_usage", 1),
    ("payout_lag", 0),
    ("driver_incentives", 4),         # payouts by trip and driver, by trip, trips, drivers
    ("profile_table", 1),             # the keys alone
])
def test_number_of_exchanges(plans, name, exchanges):
    assert _hash_exchanges(plans[name]) == exchanges


def test_checks_read_each_table_once(plans):
    """Before, the rides report took 37 scans and 67 exchanges."""
    plan = plans["dq_report_rides"]
    assert plan.count("FileScan parquet") <= 14 and plan.count("Exchange ") <= 20
    # Flat rules are counted while marts are written: what holds nothing but months is not read again.
    assert "report_month" not in plan and "gmv_to_net" not in plan and "report_month" not in plans["dq_report"]
    assert plans["payout_lag"].count("FileScan") == 1
    assert plans["mart_driver_performance"].count("FileScan") <= 5


def test_scans_read_only_what_is_used(plans):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plans["dedup_priority"])
    assert [re.sub(r"#\d+L?", "", s) for s in scans] == ["c_custkey"]
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))" in plans["stg_03_usage"]
    for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", plans["mart_marketplace_kpis"]):
        assert "o_orderpriority" not in scan and "o_orderstatus" not in scan


def test_totals_use_whole_stage_codegen(spark):
    df = QUERIES["mart_monthly_revenue"](spark, SF_SMALL)
    df.collect()
    assert "*(" in df._jdf.queryExecution().executedPlan().toString()

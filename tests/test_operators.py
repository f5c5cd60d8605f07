from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of
from tallywork.functions import cond_sum, pct0, row_count
from tallywork.operators import (
    DataQualityError, accepted, bridge, define_flags, definition_spread, dup_keys, enforce, expression, fan_in, fill,
    freshness, gap_ties, gap_trend, lookup, not_null, observable, orphans, overlap_matrix, overlap_summary, partition_check,
    profile, rank_drivers, rate_as_of, relationship, run_checks, tie_out, unique, value_counts,
)


# ---- rollup -------------------------------------------------------------------------

def test_fan_in_keeps_the_grain_and_fill_replaces_nulls(frame):
    parent = frame("k long, p string", [(1, "a"), (2, "b"), (None, "c")])
    one = frame("k long, n long", [(1, 5), (9, 9), (None, 3)])
    two = frame("k long, f boolean", [(2, True)])
    out = fill(fan_in(parent, "k", [one, two]), zeros=["n"], falses=["f"])
    assert rows_of(out, "p", "n", "f") == [("a", 5, False), ("b", 0, True), ("c", 0, False)]
    assert rows_of(lookup(parent, one, "k"), "p", "n") == [("a", 5), ("b", None), ("c", None)]


def test_fan_in_adds_no_exchange_for_aggregated_children(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(100).withColumn("k", F.col("id") % 10)
        child = facts.groupBy("k").agg(row_count().alias("n"))
        other = facts.groupBy("k").agg(F.max("id").alias("m"))
        plan = fan_in(spark.range(10).withColumnRenamed("id", "k"), "k", [child, other])
        assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- definitions --------------------------------------------------------------------

FLAGS = ["a", "b", "c"]


def _patterns(frame):
    return frame("a boolean, b boolean, c boolean", list(product([True, False], repeat=3)))


def test_overlap_of_all_patterns(frame):
    df = _patterns(frame)
    summary = overlap_summary(df, {f"n_{f}": f for f in FLAGS}, "total", "any", "all", {"a_pct": "n_a"}).first()
    assert (summary.total, summary.n_a, summary.any, summary["all"], summary.a_pct) == (8, 4, 7, 1, 50)
    matrix = overlap_matrix(df, FLAGS)
    assert matrix.count() == 8 and {r.n for r in matrix.collect()} == {1}
    spread = definition_spread(df, "a", "b").first()
    assert (spread.in_a, spread.only_a, spread.in_both, spread.only_b, spread.in_b, spread.spread) == (4, 2, 2, 2, 4, 0)


def test_flags_of_unknown_conditions_are_false(frame):
    out = define_flags(frame("x long", [(1,), (None,)]), {"f": F.col("x") > 0})
    assert [r.f for r in out.collect()] == [True, False]


# ---- bridges ------------------------------------------------------------------------

def _bridge(frame, rate=pct0):
    df = frame("t timestamp_ntz, gross decimal(12,2), net decimal(12,2)", [
        (at("2024-01-31 23:59:59"), Decimal("100.00"), Decimal("80.00")), (at("2024-01-01"), Decimal("50.00"), Decimal("40.00")),
        (at("2024-02-01"), Decimal("10.00"), None), (at("2024-03-01"), Decimal("0.00"), Decimal("0.00")),
    ])
    return bridge(
        df, F.col("t"), {"gross": F.sum("gross"), "net": F.sum("net"), "big": cond_sum(F.col("gross") > 60, F.col("gross"))},
        "gross", "net", "gap", "gap_pct", rate=rate,
    )


def test_bridge_lines_gap_and_null_sums(frame):
    assert rows_of(_bridge(frame), "report_month", "gross", "net", "big", "gap", "gap_pct") == [
        (at("2024-01-01"), 150, 120, 100, 30, 20), (at("2024-02-01"), 10, None, 0, None, None), (at("2024-03-01"), 0, 0, 0, 0, 0),
    ]
    ties = {r.report_month: r.ties for r in gap_ties(_bridge(frame), "gross", "net", "gap").collect()}
    assert ties == {at("2024-01-01"): True, at("2024-02-01"): None, at("2024-03-01"): True}


def test_tie_out_difference_and_tolerance(frame):
    mart, ledger = frame("v decimal(12,2)", [(Decimal("1.00"),), (Decimal("2.00"),)]), frame("v decimal(12,2)", [(Decimal("2.99"),)])
    strict = tie_out(mart, F.sum("v"), ledger, F.sum("v")).first()
    assert (strict.difference, strict.ties) == (Decimal("0.01"), False)
    assert tie_out(mart, F.sum("v"), ledger, F.sum("v"), tol="0.01").first().ties is True


def test_partition_check(frame):
    df = frame("t long, a long, b long", [(3, 1, 2), (3, 1, 1)])
    assert [r.partitions for r in partition_check(df, "t", ["a", "b"]).collect()] == [True, False]


def test_drivers_are_ranked_within_their_period(frame):
    df = frame("m string, x decimal(12,2), y decimal(12,2), gap decimal(12,2)", [
        ("1", Decimal("1.00"), Decimal("3.00"), Decimal("4.00")), ("2", Decimal("2.00"), Decimal("0.00"), Decimal("0.00")),
    ])
    out = rank_drivers(df, "m", ["x", "y"], "gap")
    assert rows_of(out, "m", "driver_rank", "driver", "share_of_gap_pct") == [
        ("1", 1, "y", 75), ("1", 2, "x", 25), ("2", 1, "x", None), ("2", 2, "y", None),
    ]


def test_trend_flags_jumps(frame):
    df = frame("m long, p decimal(5,2)", [(2, Decimal("11.00")), (1, Decimal("10.00")), (3, Decimal("20.00"))])
    out = gap_trend(df, "m", "p", "5")
    assert rows_of(out, "m", "change_points", "is_anomaly") == [(1, None, False), (2, 1, False), (3, 9, True)]


# ---- as-of rates --------------------------------------------------------------------

def test_rate_of_the_day_or_the_last_known(frame):
    rng = random.Random(5)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]
    quotes = [(c, d, Decimal(f"1.{i:02d}")) for c in ("EUR", "GBP") for i, d in enumerate(days[3:25]) if d.weekday() < 5]
    facts = [(i, rng.choice(["EUR", "GBP", "USD", "JPY"]), at(f"{rng.choice(days)} 13:00")) for i in range(120)]
    out = rate_as_of(
        frame("id long, c string, t timestamp_ntz", facts), frame("currency string, rate_date date, rate decimal(4,2)", quotes), "c", "t"
    )
    got = {r.id: (r.fx_rate_to_usd, r.quoted_on) for r in out.collect()}
    assert len(got) == len(facts)
    for i, c, t in facts:
        known = [(d, r) for cc, d, r in quotes if cc == c and d <= t.date()]
        expected = max(known) if known else (None, None)
        assert got[i] == ((1, None) if c == "USD" else (expected[1], expected[0]))


def test_repeated_quotes_of_a_day_do_not_multiply_facts(frame):
    quotes = frame("currency string, rate_date date, rate decimal(4,2)", [
        ("EUR", date(2024, 1, 1), Decimal("1.10")), ("EUR", date(2024, 1, 1), Decimal("1.20")), ("EUR", date(2024, 1, 3), Decimal("1.30")),
        ("EUR", None, Decimal("9.00")),
    ])
    facts = frame("c string, t timestamp_ntz", [("EUR", at("2024-01-02")), ("EUR", at("2024-01-05")), ("EUR", at("2023-12-31"))])
    assert rows_of(rate_as_of(facts, quotes, "c", "t"), "t", "fx_rate_to_usd") == [
        (at("2023-12-31"), None), (at("2024-01-02"), Decimal("1.20")), (at("2024-01-05"), Decimal("1.30")),
    ]


# ---- data quality -------------------------------------------------------------------

def _tables(frame):
    return {
        "child": frame("id long, parent_id long, kind string, v long", [
            (1, 10, "a", 1), (1, 99, "z", -1), (2, None, None, None), (None, 99, "b", 5), (None, 10, "b", 6),
        ]),
        "parent": frame("parent_id long", [(10,), (11,)]),
    }


def test_each_check_counts_its_failures(frame):
    checks = [
        unique("child", "id"), unique("child", "id", "kind"), not_null("child", "id"), accepted("child", "kind", ["a", "b"]),
        relationship("child", "parent_id", "parent", "parent_id"), expression("child", "v > 0", severity="warn"),
        not_null("parent", "parent_id"),
    ]
    report = {r.check_name: (r.failures, r.status) for r in run_checks(_tables(frame), checks).collect()}
    assert report == {
        "unique(id)": (1, "error"), "unique(id+kind)": (0, "pass"), "not_null(id)": (2, "error"),
        "accepted_values(kind)": (1, "error"),               # NULL passes
        "relationship(parent_id->parent.parent_id)": (2, "error"),
        "expression(v > 0)": (1, "warn"),                    # unknown passes
        "not_null(parent_id)": (0, "pass"),
    }


def test_checks_on_an_empty_table_pass(frame):
    empty = {"t": frame("id long, v long", [])}
    report = run_checks(empty, [unique("t", "id"), not_null("t", "v"), expression("t", "v > 0")]).collect()
    assert [(r.failures, r.status) for r in report] == [(0, "pass")] * 3


def test_observed_failures_spare_the_table(frame):
    """The report is the same, and a table with flat rules only is not read again."""
    tables = _tables(frame)
    checks = [
        unique("child", "id"), not_null("child", "id"), accepted("child", "kind", ["a", "b"]), expression("child", "v > 0", severity="warn"),
        relationship("child", "parent_id", "parent", "parent_id"), not_null("parent", "parent_id"),
    ]
    counted = {}
    for table, rules in observable(checks).items():
        found = tables[table].agg(*[column.alias(f"c{i}") for i, column in enumerate(rules.values())]).first()
        counted |= dict(zip(rules, found))
    assert len(counted) == 4
    assert rows_of(run_checks(tables, checks, counted)) == rows_of(run_checks(tables, checks))
    flat = [c for c in checks if c in counted]
    plan = run_checks(tables, flat, counted)._jdf.queryExecution().optimizedPlan().toString()
    assert "parent_id" not in plan and "kind#" not in plan and "Generate" not in plan
    for given, read in ((None, True), (counted, False)):
        plan = run_checks(tables, checks, given)._jdf.queryExecution().executedPlan().toString()
        assert (" IN (a,b)" in plan, "> 0)" in plan) == (read, read)


@pytest.mark.parametrize(("child", "parent", "values", "known"), [
    ("int", "long", [(1,), (2,), (2,), (None,)], [(1,), (None,)]), ("string", "string", [("1",), ("2",), ("2",), (None,)], [("1",), (None,)]),
    ("string", "long", [("1",), ("2",), ("2",), (None,)], [(1,), (None,)]), ("int", "string", [(1,), (2,), (2,), (None,)], [("1",), ("x",)]),
])
def test_keys_of_any_type_meet(frame, child, parent, values, known):
    tables = {"c": frame(f"k {child}", values), "p": frame(f"k {parent}", known)}
    report = run_checks(tables, [unique("c", "k"), relationship("c", "k", "p", "k"), unique("p", "k")])
    assert [r.failures for r in report.collect()] == [1, 2, 0]


def test_errors_block_and_warnings_do_not(frame):
    tables = _tables(frame)
    assert [r.status for r in enforce(run_checks(tables, [not_null("child", "id", severity="warn")]))] == ["warn"]
    with pytest.raises(DataQualityError, match=r"child: not_null\(id\) \(2\)"):
        enforce(run_checks(tables, [not_null("child", "id")]))


@pytest.mark.parametrize(("loaded", "blocking", "status"), [
    ("2024-01-03 00:00", True, "pass"), ("2024-01-02 12:00", True, "pass"), ("2024-01-02 11:59", True, "warn"),
    ("2024-01-01 23:59", True, "error"), ("2024-01-01 23:59", False, "warn"), (None, True, "error"),
])
def test_freshness_thresholds(frame, loaded, blocking, status):
    df = frame("t timestamp_ntz", [(at(loaded),), (None,)])
    assert freshness(df, "s", "t", 36, 48, "2024-01-04 00:00:00", blocking).first().status == status


def test_orphans_count_rows_per_key(frame):
    tables = _tables(frame)
    assert rows_of(orphans(tables["child"], tables["parent"], "parent_id", "parent_id")) == [(99, 2)]


# ---- profile ------------------------------------------------------------------------

def test_profile_counts_and_dup_keys(frame):
    df = frame("k long, s string, v decimal(5,2)", [(1, "a", Decimal("1.00")), (1, None, Decimal("3.00")), (2, "a", None)])
    got = {r.column_name: r for r in profile(df, ["k"]).collect()}
    assert (got["v"].rows, got["v"].distinct_keys, got["v"].nulls) == (3, 2, 1)
    assert (got["v"].min_value, got["v"].max_value, got["v"].avg_value) == (1, 3, 2)
    assert got["s"].min_value is None and got["s"].nulls == 1
    assert rows_of(dup_keys(df, ["k"])) == [(1, 2)]
    assert rows_of(value_counts(df, "s"), "value", "n", "share_pct") == [(None, 1, Decimal("33.33")), ("a", 2, Decimal("66.67"))]

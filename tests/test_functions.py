from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import at, rows_of
from tallywork.functions import (
    FIXED_RATES, GBP_ONLY, active_since, any_true, at_least, classify, cond_count, cond_sum, fx_rate, haversine_km,
    in_closed_range, lag_days, max_if, max_str, min_if, month_of, n_distinct_if, null_sentinel, out_of_order, pct, pct0,
    route_measure, to_usd, truthy,
)


def test_rates_are_exact_and_unknown_currency_counts_as_one(frame):
    df = frame("a decimal(12,2), c string", [(Decimal("10.00"), c) for c in ("GBP", "EUR", "USD", "JPY", None)])
    out = df.select("c", to_usd(F.col("a"), F.col("c")).alias("usd"))
    assert out.schema["usd"].dataType.simpleString() == "decimal(16,4)"
    assert dict(tuple(r) for r in out.collect()) == {
        "GBP": Decimal("12.7"), "EUR": Decimal("10.8"), "USD": 10, "JPY": 10, None: 10,
    }
    assert FIXED_RATES["GBP"] == GBP_ONLY["GBP"]
    euro = frame("c string", [("EUR",)]).select(fx_rate(F.col("c"), GBP_ONLY)).first()[0]
    assert euro == 1


def test_percentages_guard_zero_and_null(frame):
    df = frame("n long, d long", [(1, 8), (1, 0), (1, None), (201, 20000), (0, 5)])
    out = df.select("n", "d", pct(F.col("n"), F.col("d")).alias("safe"), pct0(F.col("n"), F.col("d")).alias("zero"))
    got = {(r.n, r.d): (r.safe, r.zero) for r in out.collect()}
    assert got[(1, 0)] == (None, 0) and got[(1, None)] == (None, 0) and got[(0, 5)] == (0, 0)
    assert got[(1, 8)] == (Decimal("12.5"), Decimal("12.5"))
    assert got[(201, 20000)][0] == Decimal("1.01")  # 1.005 rounds half up, not to even or by binary error


def test_percentage_of_wide_sums_is_rounded_once(frame):
    df = frame("n decimal(36,4), d decimal(36,4)", [(Decimal("109276.1000"), Decimal("1898802.8300"))])
    assert df.select(pct(F.col("n"), F.col("d"))).first()[0] == Decimal("5.75")  # 5.75499985 exactly


def test_month_edges_stay_without_zone(spark, frame):
    df = frame("t timestamp_ntz", [(at("2024-01-31 23:59:59"),), (at("2024-02-01 00:00:00"),)])
    for zone in ("UTC", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            out = df.select(month_of(F.col("t")).alias("m"))
            assert out.schema["m"].dataType.simpleString() == "timestamp_ntz"
            assert rows_of(out) == [(datetime(2024, 1, 1),), (datetime(2024, 2, 1),)]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lag_counts_midnights(frame):
    df = frame("a timestamp_ntz, b timestamp_ntz", [
        (at("2024-01-01 23:00:00"), at("2024-01-02 01:00:00")), (at("2024-01-01 00:00:00"), at("2024-01-01 23:59:59")),
    ])
    assert sorted(r[0] for r in df.select(lag_days(F.col("a"), F.col("b"))).collect()) == [0, 1]


def test_closed_range_ends_at_midnight(frame):
    times = ["2024-12-01 00:00:00", "2024-11-30 23:59:59", "2024-12-31 00:00:00", "2024-12-31 00:00:01"]
    df = frame("t timestamp_ntz", [(at(t),) for t in times])
    kept = df.where(in_closed_range(F.col("t"), "2024-12-01", "2024-12-31"))
    assert [r[0] for r in rows_of(kept)] == [at(times[0]), at(times[2])]


def test_active_window_includes_its_first_instant(frame):
    anchor = "2024-03-31 12:00:00"
    df = frame("t timestamp_ntz", [(at("2024-03-01 12:00:00"),), (at("2024-03-01 11:59:59"),), (None,)])
    out = df.select("t", active_since(F.col("t"), F.lit(anchor).cast("timestamp_ntz"), 30).alias("on"))
    assert {r.t: r.on for r in out.collect()} == {
        at("2024-03-01 12:00:00"): True, at("2024-03-01 11:59:59"): False, None: False,
    }


def test_flags_are_never_null(frame):
    df = frame("a long, b long", [(1, 2), (2, 1), (None, 1), (1, None)])
    out = df.select(out_of_order(F.col("a"), F.col("b")).alias("x"), at_least(F.col("a"), 2).alias("y"), truthy(F.col("a") == 1).alias("z"))
    assert [tuple(r) for r in out.collect()] == [(False, False, True), (True, True, False), (False, False, False), (False, False, True)]


def test_first_rule_wins_and_default_is_optional(frame):
    df = frame("a long", [(1,), (5,), (9,), (None,)])
    rules = [(F.col("a") > 4, "big"), (F.col("a") > 8, "huge")]
    out = df.select("a", classify(rules).alias("open"), classify(rules, "small").alias("closed"))
    assert {r.a: (r.open, r.closed) for r in out.collect()} == {
        1: (None, "small"), 5: ("big", "big"), 9: ("big", "big"), None: (None, "small"),
    }


def test_routes_are_exclusive_and_zero_elsewhere(frame):
    df = frame("m decimal(12,2), k string", [(Decimal("3.00"), "a"), (Decimal("4.00"), "b"), (Decimal("5.00"), None)])
    out = df.withColumns(route_measure(F.col("m"), {"a_sum": F.col("k") == "a", "b_sum": F.col("k") == "b"}))
    assert rows_of(out, "a_sum", "b_sum") == [(0, 0), (0, 4), (3, 0)]


def test_sentinel_becomes_null(frame):
    out = frame("a long", [(-1,), (7,)]).select(null_sentinel(F.col("a"), -1))
    assert [r[0] for r in out.collect()] == [None, 7]


def test_conditional_aggregates(frame):
    df = frame("g long, s string, v long, t timestamp_ntz", [
        (1, "ok", 5, at("2024-01-01")), (1, "no", 9, at("2024-01-09")), (1, "ok", 5, at("2024-01-03")),
        (2, "no", 1, at("2024-01-05")), (2, None, 2, None),
    ])
    ok = F.col("s") == "ok"
    out = df.groupBy("g").agg(
        cond_count(ok).alias("n"), cond_sum(ok, F.col("v")).alias("sum"), n_distinct_if(ok, F.col("v")).alias("d"),
        max_if(ok, F.col("t")).alias("last"), min_if(ok, F.col("t")).alias("first"), any_true(ok).alias("any"),
        max_str(F.col("s")).alias("s"),
    )
    assert rows_of(out) == [
        (1, 2, 10, 1, at("2024-01-03"), at("2024-01-01"), True, "ok"), (2, 0, 0, 0, None, None, False, "no"),
    ]


def test_haversine_one_degree_of_latitude(frame):
    df = frame("a double, b double, c double, d double", [(0.0, 0.0, 1.0, 0.0), (10.0, 20.0, 10.0, 20.0)])
    got = [r[0] for r in df.select(haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert abs(got[0] - 111.195) < 0.01 and got[1] == 0

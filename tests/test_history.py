from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of
from tallywork.operators import flag_events, match_lines, match_summary, known_rates, rate_as_known, restated, robust_trend, trailing_actives, validity
from tallywork.operators.matching import numbered

T0, T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3, 4))


# ---- snapshots ----------------------------------------------------------------------

def test_intervals_of_changed_withdrawn_and_returning_rows(frame):
    schema = "id long, status string, note string"
    snapshots = {
        T1: frame(schema, [(1, "a", None), (2, "a", "x"), (3, "a", None), (None, "n", None), (4, "a", "x"), (4, "a", "x")]),
        T0: frame(schema, [(1, "a", None), (2, "a", None), (3, "a", None)]),
        T2: frame(schema, [(1, "a", None), (2, "b", "x"), (None, "n", None), (5, "z", None), (5, "y", None)]),
        T3: frame(schema, [(1, "a", None), (2, "b", "x"), (3, "a", None)]),
    }
    got = rows_of(validity(snapshots, ["id"], ["status", "note"]))
    assert sorted(got, key=repr) == sorted([
        (1, "a", None, T0, None), (2, "a", None, T0, T1), (2, "a", "x", T1, T2), (2, "b", "x", T2, None), (3, "a", None, T0, T2), (3, "a", None, T3, None),
        (None, "n", None, T1, T3), (4, "a", "x", T1, T2), (5, "z", None, T2, T3), (5, "y", None, T2, T3),
    ], key=repr)


def test_flags_are_set_and_cleared(frame):
    schema = "id long, f boolean"
    snapshots = {T0: frame(schema, [(1, False), (2, True), (3, None)]), T1: frame(schema, [(1, True), (2, True), (3, None), (4, True)]), T2: frame(schema, [(1, False), (2, True), (3, True)])}
    assert rows_of(flag_events(snapshots, ["id"], "f")) == [(1, "cleared", T2), (1, "set", T1), (2, "set", T0), (3, "set", T2), (4, "cleared", T2), (4, "set", T1)]


def test_validity_exchanges_contents_not_rows(frame):
    """One aggregation by content, and no window."""
    schema = "id long, f boolean"
    plan = validity({T0: frame(schema, [(1, True)]), T1: frame(schema, [(1, True)])}, ["id"], ["f"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_a_reversal_is_booked_in_the_month_of_its_flag(frame):
    from tallywork.plans import rides

    trips = frame("trip_id long, gross_fare_usd decimal(12,2)", [(1, Decimal("10.00")), (2, Decimal("20.00")), (3, Decimal("5.00"))])
    kpis = frame("report_month timestamp_ntz, gmv_usd decimal(12,2), net_revenue_usd decimal(12,2)", [(T0, Decimal("35.00"), Decimal("30.00")), (T1, Decimal("1.00"), Decimal("1.00"))])
    events = frame("trip_id long, event string, at timestamp_ntz", [(1, "set", T1), (2, "set", T1), (1, "cleared", T3), (9, "set", T1)])
    out = rides.net_after_reversals(kpis, rides.fraud_reversals(trips, events))
    assert rows_of(out, "report_month", "flags_set", "flags_cleared", "fraud_reversal_usd", "net_after_reversals_usd", "gmv_to_net_gap_usd", "ties") == [
        (T0, 0, 0, Decimal("0.00"), Decimal("30.00"), Decimal("5.00"), True), (T1, 2, 0, Decimal("30.00"), Decimal("-29.00"), Decimal("30.00"), True),
        (T3, 0, 1, Decimal("-10.00"), Decimal("10.00"), Decimal("-10.00"), True),
    ]


# ---- restatements -------------------------------------------------------------------

ROWS = "id long, m timestamp_ntz, kind string, v decimal(12,2)"


def _restated(frame, before, after):
    kind = F.col("kind")
    money = lambda rows: [(i, m, k, None if v is None else Decimal(v)) for i, m, k, v in rows]
    return restated(frame(ROWS, money(before)), frame(ROWS, money(after)), ["id"], F.col("m"), kind, F.col("v"), kind == "in", F.lit(T1).cast("timestamp_ntz"))


def test_every_cause_and_exact_sums(frame):
    before = [(1, T0, "in", "10"), (2, T0, "in", "20"), (3, T0, "out", "5"), (4, T0, "in", "7"), (5, T0, "in", "1"), (6, T0, "in", "2"), (None, T0, "in", "3")]
    after = [
        (1, T0, "in", "10"), (2, T0, "in", "25"), (3, T0, "in", "6"), (5, T1, "in", "1.5"), (6, T0, "out", "2"), (7, T1, "in", "100"), (8, T2, "in", "50"), (None, T0, "in", "3"), (9, T2, None, "4"), (10, None, "in", "8"),
    ]
    got = {r.period: r.asDict() for r in _restated(frame, before, after).collect()}
    money = lambda p: {c: float(got[p][c]) for c in ("before", "late", "new", "corrected", "reclassified", "moved", "withdrawn", "after")}
    assert money(T0) == {"before": 43, "late": 0, "new": 0, "corrected": 5 + 1, "reclassified": 5 - 2, "moved": -1, "withdrawn": -7, "after": 44}
    assert money(T1) == {"before": 0, "late": 100, "new": 0, "corrected": 0.5, "reclassified": 0, "moved": 1, "withdrawn": 0, "after": 101.5}
    assert money(T2)["new"] == 50 and money(None)["new"] == 8 and all(r["ties"] for r in got.values())
    assert (got[T0]["n_corrected"], got[T0]["n_reclassified"], got[T0]["n_withdrawn"], got[T1]["n_late"]) == (2, 2, 1, 1)


@pytest.mark.parametrize("seed", range(3))
def test_causes_add_up_on_random_runs(frame, seed):
    rng = random.Random(seed)
    run = lambda: [(rng.choice([None, *range(60)]), rng.choice([T0, T1, T2, None]), rng.choice(["in", "out", None]), rng.choice([None, str(rng.randint(-50, 50))])) for _ in range(80)]
    before, after = run(), run()
    out = _restated(frame, before, after).collect()
    assert out and all(r.ties for r in out)
    total = lambda rows: sum(float(r) for r in rows)
    assert total(r.after - r.before for r in out) == pytest.approx(total(r.change for r in out))


# ---- line matches -------------------------------------------------------------------

LINE = "line_id long, key string, amount decimal(12,2), day date"


def brute_match(left, right, days):
    """Of all pairs still free the nearest first, then the earlier right day, then the order of the lines."""
    import hashlib

    part = lambda i: hashlib.md5(str(i).encode()).hexdigest()[:2]
    pairs = [
        (abs((r[3] - l[3]).days), (r[3] - l[3]).days, l[3], (part(l[0]), l[0]), (part(r[0]), r[0]))
        for l in left for r in right if None not in l and None not in r and l[1:3] == r[1:3] and abs((r[3] - l[3]).days) <= days
    ]
    used_left, used_right, out = set(), set(), {}
    for _, gap, _, (_, l), (_, r) in sorted(pairs):
        if l not in used_left and r not in used_right:
            used_left.add(l)
            used_right.add(r)
            out["left", l], out["right", r] = (r, gap), (l, gap)
    spare = {"left": [x for x in left if None not in x and x[0] not in used_left], "right": [x for x in right if None not in x and x[0] not in used_right]}
    rows = []
    for side, lines, others in (("left", left, spare["right"]), ("right", right, spare["left"])):
        for line in lines:
            partner, gap = out.get((side, line[0]), (None, None))
            kind = (
                ("same_day" if gap == 0 else "near_day") if partner is not None else "incomplete" if None in line
                else "other_amount" if any(o[1] == line[1] and abs((o[3] - line[3]).days) <= days for o in others)
                else "other_day" if any(o[1:3] == line[1:3] for o in others) else "missing"
            )
            rows.append((side, *line, partner, gap, kind))
    return sorted(rows, key=repr)


def random_lines(rng, n, start):
    day = lambda: date(2024, 1, 1 + rng.randint(0, 20))
    return [(start + i, rng.choice("ab"), Decimal(rng.choice([10, 10, 20])).quantize(Decimal("1.00")), day()) for i in range(n)]


@pytest.mark.parametrize(("seed", "days"), [(0, 0), (1, 2), (2, 3), (3, 30)])
def test_lines_match_one_to_one_nearest_first(frame, seed, days):
    rng = random.Random(seed)
    left, right = random_lines(rng, 70, 0), random_lines(rng, 60, 1000)
    left += [(900, None, Decimal("10.00"), date(2024, 1, 1)), (901, "a", None, date(2024, 1, 1)), (902, "a", Decimal("10.00"), None), (903, "c", Decimal("10.00"), date(2024, 1, 1))]
    right += [(1900, None, Decimal("10.00"), date(2024, 1, 1)), (1901, "c", Decimal("11.00"), date(2024, 1, 1)), (1902, "c", Decimal("10.00"), date(2025, 1, 1))]
    got = match_lines(frame(LINE, left), frame(LINE, right), days)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_match(left, right, days)


def test_a_hot_key_makes_no_pairs(frame, spark):
    """Ten thousand lines of one key, amount and day on either side: numbered in parts, matched by place."""
    one = spark.range(10_000).selectExpr("id AS line_id", "'k' AS key", "CAST(5 AS decimal(12,2)) AS amount", "date'2024-01-01' AS day")
    two = one.withColumn("line_id", F.col("line_id") + 50_000).where("line_id < 59000")
    places = numbered(one).agg(F.count("*"), F.countDistinct("place"), F.min("place"), F.max("place")).first()
    assert tuple(places) == (10_000, 10_000, 0, 9_999)
    assert rows_of(match_summary(match_lines(one, two, 3)), "side", "match_class", "n_lines") == [("left", "missing", 1_000), ("left", "same_day", 9_000), ("right", "same_day", 9_000)]


def test_an_empty_ledger(frame):
    left = frame(LINE, [(1, "a", Decimal("1.00"), date(2024, 1, 1))])
    assert rows_of(match_lines(left, frame(LINE, []), 2), "side", "line_id", "match_class") == [("left", 1, "missing")]
    assert match_lines(frame(LINE, []), frame(LINE, []), 2).count() == 0


# ---- trailing actives, trends, rates ------------------------------------------------

def test_trailing_actives_against_brute_force(frame):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, 3, 40_000, 70_000, 10**12, None]), rng.choice([None, *(datetime(2024, 1, 1 + d, 12) for d in range(0, 25, 2))])) for _ in range(60)]
    got = rows_of(trailing_actives(frame("p long, t timestamp_ntz", rows), "p", "t", [1, 7]))
    known = [(p, t.date()) for p, t in rows if p is not None and t is not None]
    days = [date.fromordinal(d) for d in range(min(t for _, t in known).toordinal(), max(t for _, t in known).toordinal() + 1)]
    assert got == [(d, len({p for p, t in known if t == d}), len({p for p, t in known if 0 <= (d - t).days < 7})) for d in days]
    assert trailing_actives(frame("p long, t timestamp_ntz", []), "p", "t", [7]).count() == 0


def test_robust_trend_of_wild_constant_and_short_pasts(frame):
    values = [10.0, 11.0, 10.5, 10.2, 99.0, 10.4, 10.8, 30.0, None, 10.1]
    rows = [(i, v) for i, v in enumerate(values)]
    got = {r.i: r for r in robust_trend(frame("i long, v double", rows), "i", "v", frame=12, least=4, limit=3.0).collect()}
    assert [i for i in got if got[i].is_anomaly] == [4, 7] and got[3].n_past == 3 and not got[3].is_anomaly
    assert got[5].baseline == 10.5 and got[9].n_past == 8 and got[8].is_anomaly is False
    flat = {r.i: (r.is_anomaly, r.score) for r in robust_trend(frame("i long, v double", [(i, 5.0) for i in range(6)] + [(6, 5.1)]), "i", "v", least=4).collect()}
    assert flat[5] == (False, None) and flat[6] == (True, None)


def test_a_close_run_again_gives_its_own_numbers(frame):
    quotes = frame("currency string, rate_date date, rate decimal(6,3), known_on date", [
        ("EUR", date(2024, 1, 1), Decimal("1.100"), date(2024, 1, 2)), ("EUR", date(2024, 1, 1), Decimal("1.200"), date(2024, 2, 1)),
        ("EUR", date(2024, 1, 3), Decimal("1.300"), date(2024, 1, 3)), ("EUR", date(2024, 1, 2), Decimal("1.150"), date(2024, 3, 1)),
    ])
    orders = frame("id long, ccy string, ts timestamp_ntz", [(1, "EUR", at("2024-01-02 10:00")), (2, "EUR", at("2024-01-04 10:00")), (3, "USD", at("2024-01-02 10:00")), (4, "EUR", at("2023-12-01 10:00"))])
    rates = lambda day: [r[1] for r in rows_of(rate_as_known(orders, quotes, "ccy", "ts", F.lit(day).cast("date")), "id", "fx_rate_to_usd")]
    assert rates("2024-01-31") == [Decimal("1.100"), Decimal("1.300"), Decimal("1.000"), None]
    assert rates("2024-02-15")[0] == Decimal("1.200") and rates("2024-04-01")[0] == Decimal("1.150")
    assert known_rates(quotes, F.lit("2023-01-01").cast("date")).count() == 0

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of
from tallywork.operators import DataQualityError, run_checks, run_trend
from tallywork.plans import build, commerce, learning, metrics, register_views, rides, run_domain, telecom
from tallywork.plans.pipeline import freshness_report
from tallywork.run import main
from tallywork.plans import pipeline
from tallywork.plans.pipeline import read_history
from tallywork.sources import SCHEMAS, current_version, current_versions, read_mart

OBSERVED = {"observation_date": date(2024, 1, 30)}


def raw_table(spark, domain, name, rows):
    """Rows given as dicts; columns left out are NULL."""
    schema = SCHEMAS[domain][name]
    return spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in rows], schema)


def usd(value):
    return None if value is None else Decimal(value)


# ---- commerce -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def shop(spark):
    day = at("2024-01-31 23:59:59")
    orders = [
        dict(order_id=i, customer_id=1, order_status=s, order_amount=usd("100.00"), currency=c, created_at=day, updated_at=day)
        for i, s, c in [
            (1, "completed", "USD"), (2, "cancelled", "USD"), (3, "completed", "EUR"), (4, "cancelled", "USD"),
            (5, "placed", "GBP"), (6, "completed", "USD"), (7, "cancelled", "USD"),
        ]
    ]
    payments = [
        dict(payment_id=i * 10 + n, order_id=i, payment_status="succeeded", amount=usd("100.00"), currency=c, gateway_fee=usd("3.00"), processed_at=at(f"2024-02-01 00:0{n}"))
        for i, n, c in [(1, 1, "USD"), (1, 2, "USD"), (2, 1, "USD"), (3, 1, "EUR"), (6, 1, "USD"), (7, 1, "USD")]
    ]
    payments.append(dict(payment_id=99, order_id=5, payment_status="failed", amount=usd("100.00"), currency="GBP", gateway_fee=usd("3.00")))
    refunds = [
        dict(refund_id=i, order_id=i, refund_amount=usd(a), currency=c, processed_at=at("2024-03-01"))
        for i, a, c in [(3, "100.00", "EUR"), (6, "40.00", "USD"), (7, "100.00", "USD")]
    ]
    parcels = [
        dict(shipment_id=1, order_id=7, status="delivered", shipped_at=None), dict(shipment_id=2, order_id=7, status="in_transit", shipped_at=day),
    ]
    return {
        "raw_orders": raw_table(spark, "commerce", "raw_orders", orders),
        "raw_payments": raw_table(spark, "commerce", "raw_payments", payments),
        "raw_refunds": raw_table(spark, "commerce", "raw_refunds", refunds),
        "raw_shipping": raw_table(spark, "commerce", "raw_shipping", parcels),
    }


def test_revenue_classes_and_economics(shop):
    got = {r.order_id: r for r in commerce.int_orders_enriched(shop).collect()}
    assert {i: r.revenue_classification for i, r in got.items()} == {
        1: "recognized", 2: "paid_but_cancelled", 3: "paid_fully_refunded", 4: "cancelled_unpaid", 5: "unpaid_open",
        6: "recognized", 7: "paid_but_cancelled",  # cancelled and fully refunded: the first rule wins
    }
    assert got[1].captured_usd == 100 and got[1].had_duplicate_charge and got[1].gateway_fee_usd == 3
    assert got[3].net_revenue_usd == 0 and got[3].is_fully_refunded and got[3].order_amount_usd == Decimal("108")
    assert got[6].net_revenue_usd == 60 and not got[6].is_fully_refunded
    assert not got[5].is_paid and got[5].captured_usd == 0 and got[5].paid_at is None
    assert (got[7].ship_status, got[7].missing_ship_date) == ("in_transit", True)


def test_bridge_algebra(shop):
    row = commerce.mart_monthly_revenue(commerce.int_orders_enriched(shop)).collect()
    assert len(row) == 1 and row[0].report_month == at("2024-01-01")
    m = row[0]
    assert m.gross_bookings_usd == m.cancelled_unpaid_usd + m.unpaid_open_usd + m.captured_cash_usd
    assert m.net_revenue_usd == m.captured_cash_usd - m.refunds_usd
    assert m.bookings_to_net_gap_usd == m.gross_bookings_usd - m.net_revenue_usd
    assert m.paid_but_cancelled_usd == 200 and m.duplicate_charge_exposure_usd == 100


def test_commerce_metrics(shop):
    assert rows_of(metrics.refunds_by_month(shop), "refunds") == [(3,)]
    assert metrics.cross_month_refunds(shop).first().cross_month_refunds == 3
    assert rows_of(metrics.ops_findings(shop)) == [(3, 1, 0, 1)]
    unknown = shop["raw_refunds"].limit(1).withColumn("order_id", F.lit(-1).cast("bigint"))
    more = {**shop, "raw_refunds": shop["raw_refunds"].unionByName(unknown)}
    assert rows_of(metrics.ops_findings(more)) == [(4, 1, 1, 1)]
    assert rows_of(metrics.status_contradictions(commerce.int_orders_enriched(shop)), "order_status", "n_orders") == [("cancelled", 1)]


# ---- rides --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def city(spark):
    day = at("2024-05-10 10:00")
    trips = [
        dict(trip_id=i, rider_id=r, driver_id=1, trip_status=s, gross_fare=usd(f), currency=c, is_fraud_flagged=x, requested_at=t)
        for i, r, s, f, c, x, t in [
            (1, 1, "completed", "10.00", "USD", False, day), (2, 1, "completed", "20.00", "GBP", True, day),
            (3, 2, "cancelled", "5.00", "USD", False, at("2024-04-10 10:00")), (4, 3, "cancelled", "0.00", "USD", False, at("2024-04-10 09:59:59")),
            (5, 3, "completed", "7.00", "USD", None, at("2024-01-01")), (6, 3, "cancelled", None, "USD", False, at("2024-01-02")),
        ]
    ]
    payments = [
        dict(payment_id=i, trip_id=t, payment_status=s, amount=usd(a), currency="USD", payment_method="card", processor_fee=usd("1.00"), captured_at=c)
        for i, t, s, a, c in [
            (1, 1, "failed", "10.00", None), (2, 1, "captured", "10.00", day), (3, 1, "captured", "10.00", at("2024-05-10 10:01")),
            (4, 2, "captured", "20.00", None), (5, 2, "captured", "20.00", None), (6, 3, "failed", "5.00", None),
        ]
    ]
    lines = [
        dict(incentive_id=i, driver_id=1, trip_id=t, campaign="c", bonus_amount=usd(b), currency=c, earned_at=at("2024-05-10 23:00"), paid_at=at("2024-05-11 01:00"))
        for i, t, b, c in [(1, 1, "2.00", "USD"), (2, 1, "3.00", "GBP"), (3, 2, "4.00", "USD"), (4, 77, "1.00", "USD")]
    ]
    return {
        "raw_riders": raw_table(spark, "rides", "raw_riders", [dict(rider_id=i, account_status=s, referred_by=b) for i, s, b in [(1, "active", 5), (2, "dormant", None), (3, "active", None), (4, "active", None)]]),
        "raw_drivers": raw_table(spark, "rides", "raw_drivers", [dict(driver_id=1, onboarded_at=at("2023-01-01"), vehicle_class="xl"), dict(driver_id=1, onboarded_at=at("2024-01-01"), vehicle_class="premium"), dict(driver_id=2, onboarded_at=at("2024-01-01"))]),
        "raw_trips": raw_table(spark, "rides", "raw_trips", trips),
        "raw_payments": raw_table(spark, "rides", "raw_payments", payments),
        "raw_driver_incentives": raw_table(spark, "rides", "raw_driver_incentives", lines),
    }


def test_trip_classes_and_routed_fares(city):
    got = {r.trip_id: (r.trip_classification, r.clean_revenue_fare, r.cancellation_fee_amount) for r in rides.stg_trips(city).collect()}
    assert got == {
        1: ("clean_completed", 10, 0), 2: ("fraud_completed", 0, 0), 3: ("billed_cancellation", 0, 5),
        4: ("zero_fare_cancellation", 0, 0), 5: (None, 0, 0), 6: (None, 0, 0),
    }


def test_enriched_trips_keep_null_without_payment(city):
    got = {r.trip_id: r for r in rides.int_trips_enriched(city).collect()}
    assert (got[1].captured_amount, got[1].had_duplicate_capture) == (10, True)
    assert got[2].captured_amount == 20 and got[2].captured_amount_usd == Decimal("25.4")
    assert (got[3].captured_amount, got[3].had_duplicate_capture) == (0, False)   # failed attempts only
    assert got[4].captured_amount is None and got[4].had_duplicate_capture is None
    assert (got[1].incentive_line_count, got[1].is_multi_campaign, got[2].is_multi_campaign) == (2, True, False)


def test_driver_payouts_tie_to_the_ledger(city):
    drivers = {r.driver_id: r for r in rides.mart_driver_performance(rides.int_trips_enriched(city), city).collect()}
    assert drivers[1].total_incentive_paid_usd == Decimal("10.81")   # 2 + 3 * 1.27 + 4 + 1
    assert drivers[1].fraud_trip_incentive_usd == 4 and drivers[1].multi_campaign_incentive_usd == Decimal("5.81")
    assert (drivers[1].is_reonboarded, drivers[1].vehicle_class, drivers[1].trips_with_incentives) == (True, "premium", 3)
    assert (drivers[2].total_trips, drivers[2].completion_rate_pct, drivers[2].first_trip_at) == (0, 0, None)
    assert drivers[1].fraud_trips == 1 and drivers[1].completion_rate_pct == 50


def test_active_riders_at_the_window_edge(city):
    got = {r.rider_id: r for r in rides.mart_rider_activity(rides.int_trips_enriched(city), city).collect()}
    flags = lambda r: (r.is_active_crm, r.is_active_requested_30d, r.is_active_completed_30d, r.is_active_clean_30d)
    assert flags(got[1]) == (True, True, True, True) and got[1].is_referred
    assert flags(got[2]) == (False, True, False, False)       # exactly 30 days before the latest trip
    assert flags(got[3]) == (True, False, False, False)       # one second earlier
    assert flags(got[4]) == (True, False, False, False) and got[4].total_trips_requested == 0


def test_payout_lag_and_exposure(city):
    assert {r.payout_lag_days for r in rides.stg_driver_incentives(city).collect()} == {1}
    row = metrics.incentive_exposure(city).first()
    assert (row.total_usd, row.fraud_usd, row.clean_usd) == (Decimal("10.81"), 4, Decimal("6.81"))
    assert rows_of(metrics.uncaptured_trips(city), "trip_id") == [(3,), (5,)]


# ---- telecom ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def network(spark):
    one = Decimal("1.000")
    return {
        "raw_subscribers": raw_table(spark, "telecom", "raw_subscribers", [
            dict(subscriber_id=1, account_status="cancelled", disconnect_reason=None, activated_at=at("2023-01-01")),
            dict(subscriber_id=2, account_status="cancelled", disconnect_reason="voluntary", activated_at=at("2023-01-01")),
            dict(subscriber_id=3, account_status="cancelled", disconnect_reason="voluntary", activated_at=at("2023-01-01")),
            dict(subscriber_id=3, account_status="active", activated_at=at("2023-06-01")),
        ]),
        "raw_plans": raw_table(spark, "telecom", "raw_plans", [dict(plan_code="p")]),
        "raw_usage": raw_table(spark, "telecom", "raw_usage", [
            dict(usage_id=i, subscriber_id=s, usage_type="data", usage_units=one, usage_date=at(t)) for i, s, t in [
                (5, 1, "2024-12-30 10:00"), (6, 1, "2024-12-30 11:00"),   # a replay of the same day
                (7, 2, "2024-12-31 00:00:01"),                            # after the midnight bound
                (8, 3, "2024-12-01 00:00:00"), (9, 3, "2024-11-30 23:59:59"),
            ]
        ]),
        "raw_support_tickets": raw_table(spark, "telecom", "raw_support_tickets", [dict(ticket_id=1, subscriber_id=1, opened_at=at("2024-01-01"))]),
        "raw_payments": raw_table(spark, "telecom", "raw_payments", [
            dict(payment_id=1, subscriber_id=1, billing_period="2024-11", payment_status="past_due", due_at=at("2024-11-01")),
            dict(payment_id=2, subscriber_id=1, billing_period="2024-11", payment_status="paid", due_at=at("2024-11-01"), paid_at=at("2024-11-09")),
            dict(payment_id=3, subscriber_id=1, billing_period="2024-12", payment_status="past_due", due_at=at("2024-12-01")),
        ]),
    }


def test_signals_and_three_definitions(network):
    signals = telecom.int_subscriber_signals(network)
    got = {r.subscriber_id: r for r in telecom.mart_subscriber_churn(signals).collect()}
    flags = lambda r: (r.is_churned_explicit, r.is_churned_payment_lapse, r.is_churned_no_usage)
    assert flags(got[1]) == (True, True, False) and got[1].usage_events_30d == 1 and got[1].last_usage_at == at("2024-12-30 10:00")
    assert got[1].past_due_periods == 2          # raw charges: the later payment does not hide the lapse
    assert (got[1].churn_type, got[1].is_likely_reactivated, got[1].unresolved_tickets) == ("not_cancelled", True, 1)
    assert flags(got[2]) == (True, False, True) and got[2].churn_type == "voluntary"
    assert flags(got[3]) == (False, False, False) and got[3].is_sim_swapped and got[3].usage_events_30d == 1
    assert {r.subscriber_id: r.lifetime_usage_events for r in signals.collect()} == {1: 1, 2: 1, 3: 2}
    summary = telecom.mart_churn_summary(telecom.mart_subscriber_churn(signals)).first()
    assert (summary.churned_any, summary.churned_all_three, summary.explicit_rate_pct) == (2, 0, Decimal("66.67"))


def test_usage_rollup_equals_the_staged_view(feeds):
    raw = feeds.raw("telecom")
    rolled = telecom.usage_rollup(raw, "2024-01-10", "2024-01-20")
    staged = telecom.stg_usage(raw)
    recent = F.col("usage_date").between(F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz"))
    expected = staged.groupBy("subscriber_id").agg(
        F.count_if(recent), F.sum(F.when(recent, F.col("usage_units")).otherwise(0)), F.max("usage_date"), F.count("*")
    )
    assert rows_of(rolled) == rows_of(expected)


# ---- learning -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def school(spark):
    lessons = [
        dict(lesson_event_id=i, enrollment_id=e, lesson_number=n, lesson_status=s, started_at=at(t), completed_at=at(c))
        for i, e, n, s, t, c in [
            (1, 1, 1, "completed", "2024-01-01", "2024-01-02"), (2, 1, 1, "completed", "2024-01-01", "2024-01-03"),
            (3, 1, 2, "completed", "2024-01-05", None), (4, 2, 1, "started", "2024-01-01", None),
            (5, 2, 1, "completed", "2024-01-02", "2024-01-02"), (6, 4, 1, "completed", "2024-01-02", "2024-01-02"),
            (7, 4, 2, "completed", "2024-01-02", "2024-01-02"),
        ]
    ]
    attempts = [
        dict(assessment_attempt_id=i, enrollment_id=e, score=s, is_passed=p, attempt_status=st)
        for i, e, s, p, st in [(1, 1, 50, False, "graded"), (2, 1, 90, True, "graded"), (3, 2, 60, False, "graded"), (4, 3, None, None, "submitted")]
    ]
    return {
        "raw_students": raw_table(spark, "learning", "raw_students", [
            dict(enrollment_id=e, student_id=e % 3, course_id=c, enrollment_status="completed" if e == 1 else "enrolled", enrolled_at=at("2024-01-01"), last_active_at=at(t))
            for e, c, t in [(1, 1, "2024-02-28"), (2, 1, "2024-01-31"), (3, 1, "2024-01-30"), (4, 1, "2024-02-21"), (5, 1, None), (6, 9, "2024-01-01")]
        ]),
        "raw_courses": raw_table(spark, "learning", "raw_courses", [dict(course_id=1, lesson_count=2, pass_threshold=70)]),
        "raw_lessons": raw_table(spark, "learning", "raw_lessons", lessons),
        "raw_assessments": raw_table(spark, "learning", "raw_assessments", attempts),
    }


def test_completion_categories(school):
    completion = learning.mart_enrollment_completion(learning.int_enrollment_progress(school))
    got = {r.enrollment_id: r for r in completion.collect()}
    assert {e: r.completion_category for e, r in got.items()} == {
        1: "passed_exam", 2: "sat_failed_exam", 3: "sat_failed_exam", 4: "finished_lessons_no_exam", 5: "incomplete", 6: "other",
    }
    assert (got[1].lessons_completed, got[1].is_complete_all_lessons, got[1].best_score, got[1].is_tested_out) == (2, True, 90, False)
    assert got[2].lessons_completed == 0         # the earlier start outranks the completion
    assert got[6].pct_lessons_completed is None and not got[6].is_complete_all_lessons
    by_status = {r.enrollment_id: r.lessons_completed for r in learning.int_enrollment_progress(school, partition_by_status=True).collect()}
    assert by_status[2] == 1
    summary = learning.mart_completion_summary(completion).first()
    assert (summary.total_enrollments, summary.total_people, summary.bridge_passed_exam) == (6, 3, 1)


def test_lesson_rollup_equals_flagged_events(feeds):
    raw = feeds.raw("learning")
    counted = F.when((F.col("lesson_status") == "completed") & F.col("is_primary_completion"), F.col("lesson_number"))
    for option in (False, True):
        flagged = learning.stg_lessons(raw, partition_by_status=option)
        expected = flagged.groupBy("enrollment_id").agg(F.count_distinct(counted), F.max(F.coalesce("completed_at", "started_at")))
        assert rows_of(learning.lesson_rollup(raw, option)) == rows_of(expected)


def test_learner_metrics(school):
    row = metrics.active_learners(school["raw_students"]).first()
    assert (row.enrollments, row.active_28d, row.active_7d, row.people, row.people_active_28d) == (6, 3, 2, 3, 2)
    assert rows_of(metrics.pass_rate(school)) == [(3, 1, Decimal("33.3"))]
    people = metrics.person_completion(learning.mart_enrollment_completion(learning.int_enrollment_progress(school))).first()
    assert (people.total_people, people.people_assessment, people.people_all_lessons) == (3, 1, 1)


# ---- declared suites and the gated run ----------------------------------------------

def test_declared_checks_match_the_published_suites():
    assert [len(d.CHECKS) for d in (commerce, rides, telecom, learning)] == [20, 43, 18, 17]
    assert telecom.expected_lines(10000).rule == "total_subscribers = 10000"


@pytest.mark.parametrize("domain", [commerce, learning], ids=["commerce", "learning"])
def test_business_rules_hold_on_the_benchmark_feeds(feeds, domain):
    name = domain.__name__.rsplit(".", 1)[1]
    report = run_checks(build(domain, feeds.raw(name)), domain.CHECKS).collect()
    assert [r.check_name for r in report if r.status != "pass"] == (["expression(lessons_completed <= lesson_count)"] if domain is learning else [])


def test_generic_tests_warn_and_rules_block():
    for domain in (commerce, rides, telecom, learning):
        for check in domain.CHECKS:
            generic = check.kind in ("unique", "not_null", "accepted_values", "relationship")
            shown = check.rule == "lessons_completed <= lesson_count"
            assert check.severity == ("warn" if generic or shown else "error"), check.name
    assert [c.table for d in (commerce, rides) for c in d.CHECKS if c.kind == "tie_out"] == ["mart_revenue", "mart_driver_performance"]



def test_run_publishes_only_what_passes(feeds, spark, tmp_path):
    out = str(tmp_path)
    raw = feeds.raw("telecom")
    done = run_domain(spark, telecom, raw, out, "r1", **OBSERVED)
    assert done.marts["mart_churn_summary"].first().total_subscribers == 150
    assert all(row.status == "pass" for row in done.checks) and len(done.checks) == 18
    with pytest.raises(DataQualityError, match="total_subscribers = 10000"):
        run_domain(spark, telecom, raw, out, "r2", checks=[*telecom.CHECKS, telecom.expected_lines(10000)], **OBSERVED)
    assert rows_of(read_mart(spark, f"{out}/mart_churn_summary")) == rows_of(done.marts["mart_churn_summary"])
    again = run_domain(spark, telecom, raw, out, "r3", checks=[], **OBSERVED)
    assert rows_of(again.marts["mart_subscriber_churn"]) == rows_of(done.marts["mart_subscriber_churn"])
    # The rejected run is remembered too.
    history = read_history(spark, out)
    assert {r.run for r in history.collect()} == {"r1", "r2", "r3"}
    assert rows_of(history.where("status = 'error'"), "run", "value") == [("r2", 1.0)]
    trend = run_trend(history.where("kind = 'rows'"), "mart_subscriber_churn", "0")
    assert [(r.run, r.change, r.is_anomaly) for r in trend.orderBy("ended_at").collect()] == [("r1", None, False), ("r2", 0.0, False), ("r3", 0.0, False)]


def test_a_rejected_rerun_of_the_current_run_changes_nothing(feeds, spark, tmp_path):
    out, raw = str(tmp_path), dict(feeds.raw("commerce"))
    done = run_domain(spark, commerce, raw, out, "d1")
    good = rows_of(done.marts["mart_revenue"], "order_id", "net_revenue_usd")
    bad = {**raw, "raw_orders": raw["raw_orders"].withColumn("order_amount", -F.col("order_amount"))}
    with pytest.raises(DataQualityError, match="order_amount_usd >= 0"):
        run_domain(spark, commerce, bad, out, "d1")
    assert rows_of(read_mart(spark, f"{out}/mart_revenue"), "order_id", "net_revenue_usd") == good
    assert rows_of(done.marts["mart_revenue"], "order_id", "net_revenue_usd") == good
    gaps = read_history(spark, out).where("subject = 'gap_pct'")
    assert gaps.count() == 2 and gaps.select("value").distinct().count() == 2


def test_a_crash_between_marts_leaves_the_old_run(feeds, spark, tmp_path, monkeypatch):
    out, raw = str(tmp_path), feeds.raw("learning")
    run_domain(spark, learning, raw, out, "r1", snapshot=False)
    before = current_versions(spark, out)

    def crash(*args):
        raise RuntimeError("crash")

    monkeypatch.setattr(pipeline, "publish", crash)
    with pytest.raises(RuntimeError, match="crash"):
        run_domain(spark, learning, raw, out, "r2", snapshot=False)
    assert current_versions(spark, out) == before


def test_payouts_to_unknown_drivers_break_the_tie(feeds, spark, tmp_path):
    """This feed has ten drivers and trips of ninety-seven."""
    with pytest.raises(DataQualityError, match="tie_out"):
        run_domain(spark, rides, feeds.raw("rides"), str(tmp_path), "r1")
    raw = dict(feeds.raw("rides"))
    known = raw["raw_drivers"].select("driver_id").distinct()
    raw["raw_driver_incentives"] = raw["raw_driver_incentives"].join(known, "driver_id", "left_semi")
    done = run_domain(spark, rides, raw, str(tmp_path), "r2")
    assert [r.status for r in done.checks if r.check_name.startswith("tie_out")] == ["pass"]


def test_checks_test_what_was_built(feeds, spark, tmp_path):
    """A feed that changes after the run has started changes neither marts nor checks."""
    raw = {}
    for name, df in feeds.raw("learning").items():
        df.write.parquet(f"{tmp_path}/raw/{name}")
        raw[name] = spark.read.parquet(f"{tmp_path}/raw/{name}")
    twice = spark.read.parquet(f"{tmp_path}/raw/raw_students").limit(5).collect()
    real = pipeline.materialise

    def late(*args, **options):
        built = real(*args, **options)
        spark.createDataFrame(twice, raw["raw_students"].schema).write.mode("append").parquet(f"{tmp_path}/raw/raw_students")
        spark.catalog.refreshByPath(f"{tmp_path}/raw/raw_students")
        return built

    pipeline.materialise, done = late, None
    try:
        done = run_domain(spark, learning, raw, f"{tmp_path}/out", "r1")
    finally:
        pipeline.materialise = real
    assert [r.failures for r in done.checks if r.table_name == "stg_students"] == [0, 0]


def test_stale_sources_block_before_anything_is_built(feeds, spark, tmp_path):
    with pytest.raises(DataQualityError, match="stale sources: raw_orders, raw_payments"):
        run_domain(spark, commerce, feeds.raw("commerce"), str(tmp_path), "r1", as_of="2030-01-01 00:00:00")
    assert list(tmp_path.iterdir()) == []
    report = {r.source: r.status for r in freshness_report(commerce, feeds.raw("commerce"), "2030-01-01 00:00:00").collect()}
    assert report["raw_refunds"] == report["raw_shipping"] == "warn"


def test_result_does_not_depend_on_partitioning(feeds):
    raw = feeds.raw("commerce")
    mixed = {name: df.repartition(5) for name, df in raw.items()}
    expected = rows_of(commerce.mart_monthly_revenue(commerce.int_orders_enriched(raw)))
    assert rows_of(commerce.mart_monthly_revenue(commerce.int_orders_enriched(mixed))) == expected


def test_models_are_available_to_sql(shop, spark):
    names = register_views(build(commerce, shop), "shop_")
    assert "shop_mart_monthly_revenue" in names and "shop_stg_payments" in names
    assert spark.sql("SELECT sum(captured_usd) FROM shop_mart_revenue WHERE is_paid").first()[0] == Decimal("508")


def test_hot_order_with_a_third_of_all_attempts(spark):
    """One order, and the NULL order, hold most attempts; flags and rollup still name one success each."""
    attempts = spark.range(0, 6000, 1, 8).selectExpr(
        "id AS payment_id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 5 = 0 THEN NULL ELSE id END AS order_id",
        "if(id % 4 = 1, 'failed', 'succeeded') AS payment_status", "CAST(id % 7 + 1 AS decimal(12,2)) AS amount",
        "'USD' AS currency", "CAST(0 AS decimal(12,2)) AS gateway_fee",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, CAST(6000 - id AS int)) AS processed_at",
    )
    schema = SCHEMAS["commerce"]["raw_payments"]
    raw = {"raw_payments": attempts.selectExpr("*", "CAST(NULL AS string) AS payment_method", "processed_at AS attempted_at").select(*schema.fieldNames())}
    staged = commerce.stg_payments(raw)
    assert staged.count() == 6000
    won = staged.where("is_primary_record AND payment_status = 'succeeded'")
    pairs = [(i, 1 if i % 3 == 0 else None if i % 5 == 0 else i) for i in range(6000) if i % 4 != 1]
    latest_id = {order: i for i, order in pairs}     # the clock runs backwards, so the highest id succeeded first
    assert {r.order_id: r.payment_id for r in won.collect()} == latest_id
    assert won.count() == len(latest_id)
    hot = [i for i, order in pairs if order == 1]
    assert {r.succeeded_per_order for r in staged.where("order_id = 1").select("succeeded_per_order").distinct().collect()} == {len(hot)}
    rolled = {r.order_id: (r.captured_usd, r.succeeded_per_order) for r in commerce.payment_rollup(raw).collect()}
    assert rolled[1] == (max(hot) % 7 + 1, len(hot))
    assert sum(n for _, n in rolled.values()) == len(pairs)


def test_run_as_a_job(feeds, spark, tmp_path, capsys):
    for name, df in feeds.raw("learning").items():
        df.write.parquet(f"{tmp_path}/raw/{name}.parquet")
    args = ["learning", f"{tmp_path}/raw", f"{tmp_path}/out", "--run", "r1"]
    assert main(args) == 0
    assert rows_of(read_mart(spark, f"{tmp_path}/out/mart_completion_summary"), "total_enrollments") == [(1500,)]
    assert main([*args[:3], "--run", "r2", "--as-of", "2030-01-01 00:00:00"]) == 1
    assert "stale sources: raw_assessments, raw_lessons" in capsys.readouterr().err
    assert current_version(spark, f"{tmp_path}/out/mart_completion_summary").startswith("r1-")

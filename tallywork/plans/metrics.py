"""Metrics the written definitions name, each from the domain tables to one small result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tallywork.functions import (
    GBP_ONLY, active_since, cond_count, cond_sum, fx_rate, haversine_km, is_missing, lag_days, month_of, pct,
    row_count, to_usd,
)
from tallywork.operators import by_month, rank_drivers, rate_as_of, with_boundary
from tallywork.plans import commerce, rides

Tables = Mapping[str, DataFrame]


# ---- commerce -----------------------------------------------------------------------

def refund_rate(monthly: DataFrame) -> DataFrame:
    """Refunded share of captured cash per order month."""
    return monthly.select(
        "report_month", "refunds_usd", "captured_cash_usd",
        pct(F.col("refunds_usd"), F.col("captured_cash_usd")).alias("refund_rate_pct"),
    )


def recognized_revenue(orders: DataFrame) -> DataFrame:
    recognized = orders.where(F.col("revenue_classification") == "recognized")
    return by_month(recognized, F.col("created_at"), {
        "recognized_orders": row_count(), "recognized_revenue_usd": F.sum("net_revenue_usd"),
    })


def refunds_by_month(raw: Tables) -> DataFrame:
    """Cash basis: refunds in the month they were paid out, not the month of the order."""
    return commerce.stg_refunds(raw).groupBy("refund_month").agg(
        row_count().alias("refunds"), F.sum("refund_amount_usd").alias("refunds_in_month_usd")
    )


def cross_month_refunds(raw: Tables) -> DataFrame:
    """Refunds paid in a later month than the order was placed, by order month."""
    refunds = commerce.stg_refunds(raw).select("order_id", "refund_month", "refund_amount_usd")
    orders = raw["raw_orders"].select("order_id", month_of(F.col("created_at")).alias("order_month"))
    later = refunds.join(orders, "order_id").where(F.col("refund_month") > F.col("order_month"))
    return later.groupBy("order_month").agg(
        row_count().alias("cross_month_refunds"), F.sum("refund_amount_usd").alias("cross_month_refunds_usd")
    )


def status_contradictions(orders: DataFrame) -> DataFrame:
    """Orders that shipped although their status says cancelled or merely placed."""
    shipped = orders.where(F.col("ship_status").isNotNull() & F.col("order_status").isin("cancelled", "placed"))
    return shipped.groupBy("order_status", "ship_status").agg(
        row_count().alias("n_orders"), F.sum("captured_usd").alias("captured_usd")
    )


def gap_drivers(monthly: DataFrame) -> DataFrame:
    return rank_drivers(
        monthly.drop("gap_pct"), "report_month",
        ["cancelled_unpaid_usd", "unpaid_open_usd", "refunds_usd", "paid_but_cancelled_usd", "duplicate_charge_exposure_usd"],
        "bookings_to_net_gap_usd",
    )


def fx_asof(raw: Tables, quotes: DataFrame) -> DataFrame:
    """Orders valued at the rate of their day, or the last one quoted before it."""
    priced = rate_as_of(
        raw["raw_orders"].select("order_id", "currency", "order_amount", "created_at"), quotes, "currency", "created_at"
    )
    return priced.withColumn("order_amount_usd", F.col("order_amount") * F.col("fx_rate_to_usd"))


def ops_findings(raw: Tables) -> DataFrame:
    """Partial refunds, refunds of orders nobody knows and duplicate charges: what the client has to fix at source."""
    orders = raw["raw_orders"].select("order_id", "order_amount")
    refunds = raw["raw_refunds"].select("order_id", "refund_amount").join(orders.withColumn("known", F.lit(True)), "order_id", "left")
    partial = refunds.agg(
        row_count().alias("all_refunds"),
        cond_count(F.col("refund_amount") < F.col("order_amount")).alias("partial_refunds"),
        cond_count(F.col("known").isNull()).alias("refunds_of_unknown_orders"),
    )
    charged = commerce.payment_rollup(raw).agg(cond_count(F.col("had_duplicate_charge")))
    return with_boundary(partial, "duplicate_charge_orders", charged)


# ---- rides --------------------------------------------------------------------------

def cancellation_rate(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        "report_month", "cancelled_trips", "total_trips",
        pct(F.col("cancelled_trips"), F.col("total_trips")).alias("cancellation_rate_pct"),
    )


def trip_distance(trips: DataFrame) -> DataFrame:
    """Per product and surge level: distance, fares and revenue per km of completed trips."""
    km = haversine_km(F.col("pickup_lat"), F.col("pickup_lon"), F.col("dropoff_lat"), F.col("dropoff_lon"))
    fare = to_usd(F.col("gross_fare"), F.col("currency"), GBP_ONLY)
    # Metres as integers: sums are exact and do not depend on the order of the rows.
    metres = F.round(km * 1000, 0).cast("bigint")
    done = trips.where(F.col("trip_status") == "completed").withColumns({"metres": metres, "fare_usd": fare})
    grouped = done.groupBy("product", "surge_multiplier").agg(
        row_count().alias("n_trips"), F.sum("metres").alias("total_metres"), F.sum("fare_usd").alias("fare_usd")
    )
    return grouped.withColumn(
        "revenue_per_km", F.round(F.col("fare_usd") * 1000 / F.nullif(F.col("total_metres"), F.lit(0)), 2)
    )


def incentive_exposure(raw: Tables) -> DataFrame:
    """One row: incentive spend split into clean, fraud and multi-campaign parts."""
    paid = F.col("bonus_amount") * fx_rate(F.col("currency"), GBP_ONLY)
    fraud, multi = F.col("is_fraud_trip"), F.col("is_multi_campaign")
    return rides.stg_driver_incentives(raw).agg(
        F.sum(paid).alias("total_usd"), cond_sum(~fraud, paid).alias("clean_usd"),
        cond_sum(fraud, paid).alias("fraud_usd"), cond_sum(multi, paid).alias("multi_campaign_usd"),
        cond_count(fraud).alias("fraud_lines"),
    )


def uncaptured_trips(raw: Tables) -> DataFrame:
    """Trips with a fare and no captured payment; the payments are reduced to trip ids first."""
    captured = raw["raw_payments"].where(F.col("payment_status") == "captured").select("trip_id").distinct()
    fares = raw["raw_trips"].where(F.col("gross_fare") > 0)
    return fares.join(captured, "trip_id", "left_anti").select("trip_id", "trip_status", "gross_fare", "currency")


def payout_findings(raw: Tables) -> DataFrame:
    """Average, shortest and longest payout lag per campaign."""
    lag = lag_days(F.col("earned_at"), F.col("paid_at"))
    grouped = raw["raw_driver_incentives"].withColumn("lag", lag).groupBy("campaign").agg(
        row_count().alias("n_lines"), F.sum("lag").alias("lag_days_sum"), F.min("lag").alias("min_lag_days"),
        F.max("lag").alias("max_lag_days"),
    )
    return grouped.withColumn("avg_lag_days", F.round(F.col("lag_days_sum") / F.col("n_lines").cast("decimal(20,0)"), 2))


# ---- telecom ------------------------------------------------------------------------

def churn_split(churn: DataFrame) -> DataFrame:
    """Cancelled lines by reason, with the share that still uses the network."""
    cancelled = churn.where(F.col("is_churned_explicit"))
    grouped = cancelled.groupBy("churn_type").agg(
        row_count().alias("n_lines"), cond_count(F.col("is_likely_reactivated")).alias("reactivated")
    )
    return grouped.withColumn("reactivation_rate_pct", pct(F.col("reactivated"), F.col("n_lines")))


def ticket_backlog(raw: Tables) -> DataFrame:
    return raw["raw_support_tickets"].groupBy("category").agg(
        row_count().alias("tickets"), cond_count(is_missing(F.col("resolved_at"))).alias("unresolved_tickets")
    )


# ---- learning -----------------------------------------------------------------------

def person_completion(completion: DataFrame) -> DataFrame:
    """People who completed at least one course under each definition, among all people."""
    flags = ["is_complete_platform", "is_complete_all_lessons", "is_complete_80pct_lessons", "is_complete_assessment"]
    people = completion.groupBy("student_id").agg(*[F.bool_or(f).alias(f) for f in flags])
    counted = people.agg(
        row_count().alias("total_people"), *[cond_count(F.col(f)).alias(f.replace("is_complete", "people")) for f in flags]
    )
    return counted.withColumns({
        f.replace("is_complete", "rate"): pct(F.col(f.replace("is_complete", "people")), F.col("total_people"), 1)
        for f in flags
    })


def active_learners(students: DataFrame) -> DataFrame:
    """Active in the last 28 and 7 days before the latest activity in the data, per enrolment and person."""
    anchored = with_boundary(
        students.select("student_id", "last_active_at"), "anchor", students.agg(F.max("last_active_at"))
    )
    marked = anchored.select(
        "student_id",
        active_since(F.col("last_active_at"), F.col("anchor"), 28).alias("a28"),
        active_since(F.col("last_active_at"), F.col("anchor"), 7).alias("a7"),
    )
    people = marked.groupBy("student_id").agg(
        row_count().alias("n"), F.count_if("a28").alias("n28"), F.count_if("a7").alias("n7")
    )
    return people.agg(
        F.sum("n").alias("enrollments"), F.sum("n28").alias("active_28d"), F.sum("n7").alias("active_7d"),
        row_count().alias("people"), F.count_if(F.col("n28") > 0).alias("people_active_28d"),
        F.count_if(F.col("n7") > 0).alias("people_active_7d"),
    )


def learning_engagement(progress: DataFrame) -> DataFrame:
    """Per course category: average lessons finished and days from enrolment to the last lesson."""
    days = lag_days(F.col("enrolled_at"), F.col("last_lesson_at"))
    grouped = progress.withColumn("days", days).groupBy("category").agg(
        row_count().alias("enrollments"), F.sum("lessons_completed").alias("lessons"),
        F.count("days").alias("with_lessons"), F.sum("days").alias("days_sum"),
    )
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    return grouped.withColumns({
        "avg_lessons_completed": F.round(exact("lessons") / exact("enrollments"), 2),
        "avg_days_to_complete": F.round(exact("days_sum") / F.nullif(exact("with_lessons"), F.lit(0)), 2),
    }).drop("lessons", "days_sum")


def pass_rate(raw: Tables) -> DataFrame:
    """Passing share of graded attempts."""
    graded = raw["raw_assessments"].where(F.col("attempt_status") == "graded")
    counted = graded.agg(row_count().alias("graded_attempts"), cond_count(F.col("is_passed")).alias("passed_attempts"))
    return counted.withColumn("pass_rate_pct", pct(F.col("passed_attempts"), F.col("graded_attempts"), 1))

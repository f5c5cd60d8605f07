"""Ride-hailing: drivers, riders under four definitions of active, and the GMV-to-net bridge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallywork.functions import (
    GBP_ONLY, active_since, any_true, classify, cond_count, cond_sum, fx_rate, is_present, lag_days, max_if, max_str,
    pct, pct0, route_measure, row_count, span, truthy,
)
from tallywork.functions.times import month_of
from tallywork.operators import (
    accepted, bridge, dedup_latest, define_flags, expression, fan_in, fill, first_success_rollup, flag_multi,
    flag_primary, generic_warn, not_null, relationship, tie_out_check, unique, with_boundary,
)

Tables = Mapping[str, DataFrame]

_CAPTURE_ORDER = ["captured_at", "payment_id"]
TRIP_CLASSES = ["clean_completed", "fraud_completed", "billed_cancellation", "zero_fare_cancellation"]


# ---- staging ------------------------------------------------------------------------

def stg_riders(raw: Tables) -> DataFrame:
    return raw["raw_riders"].withColumn("is_referred", is_present(F.col("referred_by")))


def stg_drivers(raw: Tables) -> DataFrame:
    return dedup_latest(
        raw["raw_drivers"], ["driver_id"], ["onboarded_at"], count_col="onboarding_count", flag_col="is_reonboarded"
    )


def trip_rules() -> dict[str, Column]:
    """Conditions of the four trip classes; none holds when the deciding column is NULL."""
    completed, cancelled = F.col("trip_status") == "completed", F.col("trip_status") == "cancelled"
    fraud, fare = F.col("is_fraud_flagged"), F.col("gross_fare")
    return {
        "clean_completed": completed & ~fraud,
        "fraud_completed": completed & fraud,
        "billed_cancellation": cancelled & (fare > 0),
        "zero_fare_cancellation": cancelled & (fare == 0),
    }


def stg_trips(raw: Tables) -> DataFrame:
    rules = trip_rules()
    return raw["raw_trips"].withColumns({
        "trip_classification": classify([(rules[name], name) for name in TRIP_CLASSES]),
        **route_measure(F.col("gross_fare"), {
            "clean_revenue_fare": rules["clean_completed"],
            "cancellation_fee_amount": rules["billed_cancellation"],
        }),
    })


def stg_payments(raw: Tables) -> DataFrame:
    return flag_primary(
        raw["raw_payments"], ["trip_id"], "payment_status", "captured", _CAPTURE_ORDER,
        count_col="captures_per_trip", duplicate_col="is_duplicate_capture", primary_col="is_primary_record",
    )


def payout_lag(lines: DataFrame) -> DataFrame:
    """What a payout line says by itself, without its trip."""
    return lines.withColumn("payout_lag_days", lag_days(F.col("earned_at"), F.col("paid_at")))


def stg_driver_incentives(raw: Tables) -> DataFrame:
    fraud = raw["raw_trips"].select("trip_id", F.col("is_fraud_flagged").alias("is_fraud_trip"))
    lines = flag_multi(
        raw["raw_driver_incentives"], ["trip_id"], "campaign_lines_per_trip", "is_multi_campaign", lookup=fraud
    )
    return payout_lag(lines.withColumn("is_fraud_trip", truthy(F.col("is_fraud_trip"))))


# ---- children at trip grain ---------------------------------------------------------

def payment_rollup(raw: Tables) -> DataFrame:
    rolled = first_success_rollup(
        raw["raw_payments"], ["trip_id"], "payment_status", "captured", _CAPTURE_ORDER,
        measures={"captured_amount": F.col("amount"), "processor_fee": F.col("processor_fee")},
        count_col="captures_per_trip",
        extra={
            "payment_currency": max_str(F.col("currency")), "payment_method": max_str(F.col("payment_method")),
            "captured_at": F.max("captured_at"),
        },
    )
    return rolled.withColumn("had_duplicate_capture", F.col("captures_per_trip") > 1)


def incentive_rollup(raw: Tables) -> DataFrame:
    rolled = raw["raw_driver_incentives"].groupBy("trip_id").agg(
        F.sum("bonus_amount").alias("total_incentive_amount"), row_count().alias("incentive_line_count"),
        max_str(F.col("currency")).alias("incentive_currency"),
    )
    return rolled.withColumn("is_multi_campaign", F.col("incentive_line_count") > 1)


# ---- intermediate -------------------------------------------------------------------

def int_trips_enriched(raw: Tables) -> DataFrame:
    """Trips with payment and incentive totals; trips without either keep NULL there."""
    joined = fan_in(stg_trips(raw), "trip_id", [payment_rollup(raw), incentive_rollup(raw)])
    rate = fx_rate(F.col("currency"), GBP_ONLY)
    converted = {
        "gross_fare_usd": "gross_fare", "clean_revenue_fare_usd": "clean_revenue_fare",
        "cancellation_fee_usd": "cancellation_fee_amount", "captured_amount_usd": "captured_amount",
        "processor_fee_usd": "processor_fee", "total_incentive_usd": "total_incentive_amount",
    }
    return joined.select(
        "trip_id", "rider_id", "driver_id", "city", "product", "trip_status", "cancel_reason",
        "trip_classification", "currency", "is_fraud_flagged", "requested_at", "accepted_at", "started_at",
        "ended_at", "surge_multiplier", "gross_fare", "clean_revenue_fare", "cancellation_fee_amount",
        rate.alias("fx_rate_to_usd"),
        "captured_amount", "processor_fee", "payment_method", "captured_at", "captures_per_trip",
        "had_duplicate_capture", "total_incentive_amount", "incentive_line_count", "is_multi_campaign",
        *[(F.col(local) * rate).alias(usd) for usd, local in converted.items()],
    )


# ---- marts --------------------------------------------------------------------------

def _status(value: str) -> Column:
    return F.col("trip_status") == value


def _class(value: str) -> Column:
    return F.col("trip_classification") == value


def _duplicate_exposure() -> Column:
    return cond_sum(F.col("had_duplicate_capture"), F.col("captured_amount_usd"))


def trip_stats_by_driver(trips: DataFrame) -> DataFrame:
    return trips.groupBy("driver_id").agg(
        row_count().alias("total_trips"),
        cond_count(_status("completed")).alias("completed_trips"),
        cond_count(_status("cancelled")).alias("cancelled_trips"),
        cond_count(F.col("is_fraud_flagged")).alias("fraud_trips"),
        cond_count(_class("clean_completed")).alias("clean_completed_trips"),
        F.sum("gross_fare_usd").alias("gross_fare_usd"),
        F.sum("clean_revenue_fare_usd").alias("clean_revenue_usd"),
        F.sum("captured_amount_usd").alias("total_captured_usd"),
        F.sum("processor_fee_usd").alias("total_processor_fees_usd"),
        _duplicate_exposure().alias("duplicate_capture_exposure_usd"),
        *span(F.col("requested_at"), "first_trip_at", "last_trip_at"),
    )


def incentives_by_driver(raw: Tables) -> DataFrame:
    """Payouts per driver from every ledger line, in the line's own currency.

    Lines are summed per trip and driver first.  The trip's number of lines and its fraud flag are taken on those rows, of
    which a trip has one per driver, and a last aggregation brings them to the driver.
    """
    paid = F.col("bonus_amount") * fx_rate(F.col("currency"), GBP_ONLY)
    pairs = raw["raw_driver_incentives"].groupBy("trip_id", "driver_id").agg(F.sum(paid).alias("paid"), row_count().alias("lines"))
    pairs = pairs.withColumn("is_multi_campaign", F.sum("lines").over(W.partitionBy("trip_id")) > 1)
    fraud = raw["raw_trips"].select("trip_id", F.col("is_fraud_flagged").alias("is_fraud_trip"))
    return pairs.join(fraud, "trip_id", "left").groupBy("driver_id").agg(
        F.sum("paid").alias("total_incentive_paid_usd"),
        cond_sum(truthy(F.col("is_fraud_trip")), F.col("paid")).alias("fraud_trip_incentive_usd"),
        cond_sum(F.col("is_multi_campaign"), F.col("paid")).alias("multi_campaign_incentive_usd"),
        F.sum("lines").alias("total_incentive_lines"),
        F.count("trip_id").alias("trips_with_incentives"),
    )


def mart_driver_performance(trips: DataFrame, raw: Tables) -> DataFrame:
    drivers = stg_drivers(raw)
    joined = fan_in(
        drivers, "driver_id", [trip_stats_by_driver(trips), incentives_by_driver(raw)]
    )
    unfilled = [*drivers.columns, "first_trip_at", "last_trip_at"]
    filled = fill(joined, zeros=[c for c in joined.columns if c not in unfilled])
    return filled.withColumns({
        "completion_rate_pct": pct0(F.col("completed_trips"), F.col("total_trips")),
        "fraud_rate_pct": pct0(F.col("fraud_trips"), F.col("completed_trips")),
    })


def trip_stats_by_rider(trips: DataFrame) -> DataFrame:
    requested = F.col("requested_at")
    return trips.groupBy("rider_id").agg(
        row_count().alias("total_trips_requested"),
        cond_count(_status("completed")).alias("completed_trips"),
        cond_count(_class("clean_completed")).alias("clean_completed_trips"),
        cond_count(_class("fraud_completed")).alias("fraud_completed_trips"),
        cond_count(_status("cancelled")).alias("cancelled_trips"),
        F.sum("gross_fare_usd").alias("total_gross_fare_usd"),
        F.sum("clean_revenue_fare_usd").alias("total_clean_revenue_usd"),
        F.sum("captured_amount_usd").alias("total_captured_usd"),
        *span(requested, "first_trip_at", "last_trip_at"),
        max_if(_status("completed"), requested).alias("last_completed_at"),
        max_if(_class("clean_completed"), requested).alias("last_clean_completed_at"),
    )


def mart_rider_activity(trips: DataFrame, raw: Tables, window_days: int = 30) -> DataFrame:
    """Four definitions of an active rider, anchored to the latest trip in the data."""
    riders = stg_riders(raw).drop("referred_by")
    joined = with_boundary(
        fan_in(riders, "rider_id", [trip_stats_by_rider(trips)]), "max_trip_date", trips.agg(F.max("requested_at"))
    )
    filled = fill(joined, zeros=[
        "total_trips_requested", "completed_trips", "clean_completed_trips", "fraud_completed_trips",
        "cancelled_trips", "total_gross_fare_usd", "total_clean_revenue_usd", "total_captured_usd",
    ])
    anchor = F.col("max_trip_date")
    flagged = define_flags(filled, {
        "is_active_crm": F.col("account_status") == "active",
        "is_active_requested_30d": active_since(F.col("last_trip_at"), anchor, window_days),
        "is_active_completed_30d": active_since(F.col("last_completed_at"), anchor, window_days),
        "is_active_clean_30d": active_since(F.col("last_clean_completed_at"), anchor, window_days),
    })
    return flagged.drop("max_trip_date", "last_completed_at", "last_clean_completed_at")


def mart_marketplace_kpis(trips: DataFrame) -> DataFrame:
    """GMV-to-net bridge.  Net is captured cash minus fees; fraud fares are shown, not deducted twice."""
    fare = F.col("gross_fare_usd")
    return bridge(
        trips, F.col("requested_at"),
        lines={
            "total_trips": row_count(),
            "completed_trips": cond_count(_status("completed")),
            "cancelled_trips": cond_count(_status("cancelled")),
            **{f"{name}_trips": cond_count(_class(name)) for name in TRIP_CLASSES},
            "gmv_usd": F.sum(fare),
            "zero_fare_cancel_usd": cond_sum(_class("zero_fare_cancellation"), fare),
            "fraud_fare_usd": cond_sum(_class("fraud_completed"), fare),
            "cancellation_fee_revenue_usd": F.sum("cancellation_fee_usd"),
            "clean_trip_revenue_usd": F.sum("clean_revenue_fare_usd"),
            "total_captured_usd": F.sum("captured_amount_usd"),
            "total_processor_fees_usd": F.sum("processor_fee_usd"),
            "duplicate_capture_exposure_usd": _duplicate_exposure(),
            "total_incentive_spend_usd": F.sum("total_incentive_usd"),
            "fraud_incentive_spend_usd": cond_sum(
                F.col("is_fraud_flagged") & F.col("total_incentive_usd").isNotNull(), F.col("total_incentive_usd")
            ),
        },
        derived={
            "net_revenue_usd": F.col("total_captured_usd") - F.col("total_processor_fees_usd"),
            "completion_rate_pct": pct(F.col("completed_trips"), F.col("total_trips")),
            "fraud_rate_pct": pct(F.col("fraud_completed_trips"), F.col("completed_trips")),
            "take_rate_pct": pct0(
                F.col("total_captured_usd") - F.col("total_processor_fees_usd"), F.col("gmv_usd")
            ),
        },
        start="gmv_usd", end="net_revenue_usd", gap="gmv_to_net_gap_usd", gap_pct="gmv_to_net_gap_pct", rate=pct0,
    )


def net_after_fraud(kpis: DataFrame) -> DataFrame:
    """Net revenue with fraud fares reversed as well: the reading of the written definition."""
    return kpis.withColumn("net_after_fraud_usd", F.col("net_revenue_usd") - F.col("fraud_fare_usd"))


def fraud_reversals(trips: DataFrame, events: DataFrame) -> DataFrame:
    """Fares reversed per month in which the flag was set, less those whose flag was cleared in it.

    ``events`` come from the kept snapshots (``flag_events`` on ``is_fraud_flagged``).  A trip nobody knows any more reverses nothing.
    """
    fares = trips.select("trip_id", "gross_fare_usd")
    booked = events.join(fares, "trip_id").withColumn("is_set", F.col("event") == "set")
    return booked.groupBy(month_of(F.col("at")).alias("report_month")).agg(
        cond_count(F.col("is_set")).alias("flags_set"), cond_count(~F.col("is_set")).alias("flags_cleared"),
        F.sum(F.when(F.col("is_set"), F.col("gross_fare_usd")).otherwise(-F.col("gross_fare_usd"))).alias("fraud_reversal_usd"),
    )


def net_after_reversals(kpis: DataFrame, reversals: DataFrame) -> DataFrame:
    """The bridge with fraud reversed in the month the flag was set: a month can hold reversals of trips of earlier ones.

    Months with reversals and without trips have a row of their own, so the reversals of all months are those of all flags.
    """
    both = kpis.select("report_month", "gmv_usd", "net_revenue_usd").join(reversals, "report_month", "full")
    filled = fill(both, zeros=["gmv_usd", "net_revenue_usd", "flags_set", "flags_cleared", "fraud_reversal_usd"])
    after = F.col("net_revenue_usd") - F.col("fraud_reversal_usd")
    gap = F.col("gmv_usd") - after
    return filled.withColumns({
        "net_after_reversals_usd": after, "gmv_to_net_gap_usd": gap,
        "ties": gap == (F.col("gmv_usd") - F.col("net_revenue_usd")) + F.col("fraud_reversal_usd"),
    })


# ---- declaration for the run --------------------------------------------------------

STAGING = {
    "stg_riders": stg_riders, "stg_drivers": stg_drivers, "stg_trips": stg_trips, "stg_payments": stg_payments,
    "stg_driver_incentives": stg_driver_incentives,
}
# Staging that only adds flags to its feed: same rows, same keys.
FLAGS_ONLY = {"stg_riders": "raw_riders", "stg_trips": "raw_trips", "stg_payments": "raw_payments", "stg_driver_incentives": "raw_driver_incentives"}
INTERMEDIATE = "int_trips_enriched"


def intermediate(raw: Tables, **_) -> DataFrame:
    return int_trips_enriched(raw)


def marts(inter: DataFrame, raw: Tables) -> dict[str, DataFrame]:
    return {
        "mart_driver_performance": mart_driver_performance(inter, raw),
        "mart_rider_activity": mart_rider_activity(inter, raw),
        "mart_marketplace_kpis": mart_marketplace_kpis(inter).orderBy("report_month"),
    }


_STAGED_KEYS = [
    ("stg_riders", "rider_id"), ("stg_drivers", "driver_id"), ("stg_trips", "trip_id"),
    ("stg_payments", "payment_id"), ("stg_driver_incentives", "incentive_id"),
]
_FOREIGN_KEYS = [
    ("stg_trips", "rider_id", "stg_riders"), ("stg_trips", "driver_id", "stg_drivers"),
    ("stg_payments", "trip_id", "stg_trips"), ("stg_driver_incentives", "trip_id", "stg_trips"),
    ("stg_driver_incentives", "driver_id", "stg_drivers"),
]
CHECKS = generic_warn([
    *[check(f"raw_{table}", key) for table, key in [
        ("riders", "rider_id"), ("trips", "trip_id"), ("payments", "payment_id"),
        ("driver_incentives", "incentive_id"),
    ] for check in (unique, not_null)],
    not_null("raw_drivers", "driver_id"),
    *[check(table, key) for table, key in _STAGED_KEYS for check in (unique, not_null)],
    not_null("stg_trips", "trip_classification"),
    accepted("stg_trips", "trip_classification", TRIP_CLASSES),
    *[not_null(table, key) for table, key, _ in _FOREIGN_KEYS],
    *[relationship(table, key, parent, key) for table, key, parent in _FOREIGN_KEYS],
    *[check(table, key) for table, key in [
        ("mart_driver_performance", "driver_id"), ("mart_rider_activity", "rider_id"),
    ] for check in (unique, not_null)],
    expression("mart_driver_performance", "completion_rate_pct between 0 and 100"),
    expression("mart_driver_performance", "total_incentive_paid_usd >= 0"),
    expression("mart_rider_activity", "completed_trips <= total_trips_requested"),
    expression("mart_rider_activity", "clean_completed_trips <= completed_trips"),
    expression("mart_marketplace_kpis", "gmv_usd >= net_revenue_usd"),
    expression("mart_marketplace_kpis", "fraud_rate_pct between 0 and 100"),
    expression("mart_marketplace_kpis", "round(gmv_usd - net_revenue_usd, 2) = round(gmv_to_net_gap_usd, 2)"),
    tie_out_check(
        "mart_driver_performance", "sum(total_incentive_paid_usd)", "raw_driver_incentives",
        "sum(bonus_amount * if(currency = 'GBP', 1.27, 1.0))",
    ),
])

# Numbers whose change from run to run is watched.
HEADLINES = {"gap_pct": ("mart_marketplace_kpis", "100 * sum(gmv_to_net_gap_usd) / sum(gmv_usd)")}

# Loaded-at column, warn and error age in hours, and whether an error blocks.
FRESHNESS = {
    "raw_trips": ("requested_at", 36, 48, True),
    "raw_payments": ("attempted_at", 36, 48, True),
    "raw_driver_incentives": ("paid_at", 192, 336, False),
}

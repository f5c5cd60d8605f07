"""Telecom: one row per line with three definitions of churn, and how they overlap."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tallywork.functions import (
    at_least, classify, cond_count, cond_sum, in_closed_range, is_missing, max_if, row_count, truthy,
)
from tallywork.operators import (
    accepted, dedup_business_key, dedup_latest, dedup_priority, define_flags, expression, fan_in, fill, generic_warn,
    not_null, overlap_summary, unique,
)

Tables = Mapping[str, DataFrame]

CHURN_TYPES = ["voluntary", "involuntary", "ported_out"]
CHURN_FLAGS = ["is_churned_explicit", "is_churned_payment_lapse", "is_churned_no_usage"]
# The published observation date, window and lapse threshold.
OBSERVATION_DATE = date(2024, 12, 31)
WINDOW_DAYS = 30
LAPSE_PERIODS = 1
_LAST_ID = 2**63 - 1


# ---- staging ------------------------------------------------------------------------

def stg_subscribers(raw: Tables) -> DataFrame:
    latest = dedup_latest(
        raw["raw_subscribers"], ["subscriber_id"], ["activated_at"], count_col="row_ct", flag_col="is_sim_swapped"
    )
    return latest.drop("row_ct")


def stg_plans(raw: Tables) -> DataFrame:
    return raw["raw_plans"]


def stg_usage(raw: Tables) -> DataFrame:
    """Mediation replays removed: same line, day, type and units count once, lowest id kept."""
    return dedup_business_key(
        raw["raw_usage"],
        ["subscriber_id", F.col("usage_date").cast("date"), "usage_type", "usage_units"], ["usage_id"],
    )


def stg_payments(raw: Tables) -> DataFrame:
    """Most authoritative outcome per billing period."""
    return dedup_priority(
        raw["raw_payments"], ["subscriber_id", "billing_period"], "payment_status", {"paid": 3, "past_due": 2},
        [F.coalesce("paid_at", "due_at"), "payment_id"], otherwise=1,
    )


def stg_support_tickets(raw: Tables) -> DataFrame:
    return raw["raw_support_tickets"].withColumn("is_unresolved", is_missing(F.col("resolved_at")))


# ---- children at line grain ---------------------------------------------------------

def usage_rollup(raw: Tables, low, high) -> DataFrame:
    """Lifetime and in-window usage in one pass over the feed.

    The replay dedup keeps the instant of the lowest id per business key, which is a
    ``min_by`` over fixed-width values, and both horizons are conditional aggregates on it.
    """
    first_id = F.coalesce(F.col("usage_id"), F.lit(_LAST_ID))
    events = raw["raw_usage"].groupBy(
        "subscriber_id", F.col("usage_date").cast("date").alias("usage_day"), "usage_type", "usage_units"
    ).agg(F.min_by("usage_date", first_id).alias("usage_date"))
    recent = in_closed_range(F.col("usage_date"), low, high)
    return events.groupBy("subscriber_id").agg(
        cond_count(recent).alias("usage_events_30d"),
        cond_sum(recent, F.col("usage_units")).alias("usage_units_30d"),
        F.max("usage_date").alias("last_usage_at"),
        row_count().alias("lifetime_usage_events"),
    )


def payment_rollup(raw: Tables) -> DataFrame:
    """Counted on all raw charges: deduplicating first would hide lapsed periods."""
    status = F.col("payment_status")
    return raw["raw_payments"].groupBy("subscriber_id").agg(
        cond_count(status == "past_due").alias("past_due_periods"),
        cond_count(status == "failed").alias("failed_periods"),
        max_if(status == "past_due", F.col("due_at")).alias("last_past_due_at"),
    )


def ticket_rollup(raw: Tables) -> DataFrame:
    return raw["raw_support_tickets"].groupBy("subscriber_id").agg(
        row_count().alias("ticket_count"),
        cond_count(is_missing(F.col("resolved_at"))).alias("unresolved_tickets"),
    )


# ---- intermediate -------------------------------------------------------------------

def int_subscriber_signals(
    raw: Tables, observation_date: date = OBSERVATION_DATE, window_days: int = WINDOW_DAYS
) -> DataFrame:
    low = observation_date - timedelta(days=window_days)
    joined = fan_in(
        stg_subscribers(raw), "subscriber_id",
        [usage_rollup(raw, low, observation_date), payment_rollup(raw), ticket_rollup(raw)],
    )
    return fill(joined, zeros=[
        "usage_events_30d", "usage_units_30d", "lifetime_usage_events", "past_due_periods", "failed_periods",
        "ticket_count", "unresolved_tickets",
    ])


# ---- marts --------------------------------------------------------------------------

def churn_type() -> Column:
    cancelled, reason = F.col("account_status") == "cancelled", F.col("disconnect_reason")
    return classify([(cancelled & (reason == name), name) for name in CHURN_TYPES], default="not_cancelled")


def mart_subscriber_churn(signals: DataFrame, lapse_periods: int = LAPSE_PERIODS) -> DataFrame:
    cancelled = F.col("account_status") == "cancelled"
    flagged = define_flags(signals, {
        "is_churned_explicit": cancelled,
        "is_churned_payment_lapse": at_least(F.col("past_due_periods"), lapse_periods),
        "is_churned_no_usage": F.col("usage_events_30d") == 0,
    })
    described = flagged.withColumns({
        "churn_type": churn_type(),
        "is_likely_reactivated": truthy(cancelled & (F.col("usage_events_30d") > 0)),
    })
    return described.drop("activated_at", "cancelled_at", "lifetime_usage_events", "failed_periods", "last_past_due_at")


def mart_churn_summary(churn: DataFrame) -> DataFrame:
    return overlap_summary(
        churn,
        flags={
            "churned_explicit": "is_churned_explicit", "churned_payment_lapse": "is_churned_payment_lapse",
            "churned_no_usage": "is_churned_no_usage",
        },
        total="total_subscribers", any_col="churned_any", all_col="churned_all_three",
        rates={
            "explicit_rate_pct": "churned_explicit", "payment_lapse_rate_pct": "churned_payment_lapse",
            "no_usage_rate_pct": "churned_no_usage",
        },
        extra={"likely_reactivated": cond_count(F.col("is_likely_reactivated"))},
    )


# ---- declaration for the run --------------------------------------------------------

STAGING = {
    "stg_subscribers": stg_subscribers, "stg_plans": stg_plans, "stg_usage": stg_usage,
    "stg_payments": stg_payments, "stg_support_tickets": stg_support_tickets,
}
# Staging that only adds flags to its feed: same rows, same keys.
FLAGS_ONLY = {"stg_plans": "raw_plans", "stg_support_tickets": "raw_support_tickets"}
INTERMEDIATE = "int_subscriber_signals"


def intermediate(raw: Tables, observation_date: date = OBSERVATION_DATE, window_days: int = WINDOW_DAYS) -> DataFrame:
    return int_subscriber_signals(raw, observation_date, window_days)


def marts(inter: DataFrame, raw: Tables) -> dict[str, DataFrame]:
    churn = mart_subscriber_churn(inter)
    return {"mart_subscriber_churn": churn, "mart_churn_summary": mart_churn_summary(churn)}


def expected_lines(n: int):
    """Row-count expectation for the summary; the published one holds for its own sample only."""
    return expression("mart_churn_summary", f"total_subscribers = {n}")


CHECKS = generic_warn([
    *[check(table, key) for table, key in [
        ("stg_subscribers", "subscriber_id"), ("stg_plans", "plan_code"), ("stg_usage", "usage_id"),
        ("stg_payments", "payment_id"), ("stg_support_tickets", "ticket_id"),
        ("int_subscriber_signals", "subscriber_id"), ("mart_subscriber_churn", "subscriber_id"),
    ] for check in (unique, not_null)],
    accepted("mart_subscriber_churn", "churn_type", [*CHURN_TYPES, "not_cancelled"]),
    expression("mart_subscriber_churn", "usage_events_30d >= 0"),
    expression("mart_subscriber_churn", "past_due_periods >= 0"),
    expression("mart_churn_summary", "churned_any >= churned_all_three"),
])

# Loaded-at column, warn and error age in hours, and whether an error blocks.
FRESHNESS = {
    "raw_usage": ("usage_date", 36, 48, True),
    "raw_payments": ("due_at", 36, 48, True),
    "raw_subscribers": ("activated_at", 48, 72, False),
    "raw_support_tickets": ("opened_at", 120, 240, False),
}

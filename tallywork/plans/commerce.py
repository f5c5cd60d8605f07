"""Commerce: from gross bookings to net revenue, order by order and month by month."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallywork.functions import (
    any_true, classify, cond_sum, is_missing, max_if, max_str, month_of, out_of_order, row_count, to_usd, truthy,
)
from tallywork.operators import (
    accepted, bridge, expression, fan_in, fill, first_success_rollup, flag_primary, generic_warn, not_null, tie_out_check,
    unique,
)

Tables = Mapping[str, DataFrame]

_PAYMENT_ORDER = ["processed_at", "payment_id"]
REVENUE_CLASSES = ["recognized", "paid_but_cancelled", "paid_fully_refunded", "cancelled_unpaid", "unpaid_open"]


def _usd(amount: str) -> Column:
    return to_usd(F.col(amount), F.col("currency"))


# ---- staging ------------------------------------------------------------------------

def stg_orders(raw: Tables) -> DataFrame:
    return raw["raw_orders"].withColumns({
        "order_amount_usd": _usd("order_amount"),
        "has_invalid_timestamp": out_of_order(F.col("created_at"), F.col("updated_at")),
    })


def stg_payments(raw: Tables) -> DataFrame:
    flagged = flag_primary(
        raw["raw_payments"], ["order_id"], "payment_status", "succeeded", _PAYMENT_ORDER,
        count_col="succeeded_per_order", duplicate_col="is_duplicate_charge", primary_col="is_primary_record",
    )
    return flagged.withColumns({"amount_usd": _usd("amount"), "gateway_fee_usd": _usd("gateway_fee")})


def stg_refunds(raw: Tables) -> DataFrame:
    return raw["raw_refunds"].withColumns({
        "refund_amount_usd": _usd("refund_amount"), "refund_month": month_of(F.col("processed_at")),
    })


def stg_shipping(raw: Tables) -> DataFrame:
    return raw["raw_shipping"].withColumns({
        "missing_ship_date": is_missing(F.col("shipped_at")),
        "missing_delivery_date": is_missing(F.col("delivered_at")),
    })


# ---- children at order grain --------------------------------------------------------

def payment_rollup(raw: Tables) -> DataFrame:
    """Cash per order from the first successful charge only, in one aggregation."""
    rolled = first_success_rollup(
        raw["raw_payments"], ["order_id"], "payment_status", "succeeded", _PAYMENT_ORDER,
        measures={"captured_usd": _usd("amount"), "gateway_fee_usd": _usd("gateway_fee")},
        count_col="succeeded_per_order",
        extra={"paid_at": max_if(F.col("payment_status") == "succeeded", F.col("processed_at"))},
    )
    return rolled.withColumn("had_duplicate_charge", F.col("succeeded_per_order") > 1)


def refund_rollup(raw: Tables) -> DataFrame:
    return stg_refunds(raw).groupBy("order_id").agg(
        F.sum("refund_amount_usd").alias("refund_usd"), row_count().alias("refund_count"),
        F.max("processed_at").alias("last_refund_at"),
    )


def shipping_rollup(raw: Tables) -> DataFrame:
    return raw["raw_shipping"].groupBy("order_id").agg(
        max_str(F.col("status")).alias("ship_status"), F.max("shipped_at").alias("shipped_at"),
        any_true(is_missing(F.col("shipped_at"))).alias("missing_ship_date"),
    )


# ---- intermediate -------------------------------------------------------------------

def revenue_class(paid: Column, status: Column, refund: Column, amount: Column) -> Column:
    """First rule that holds; an order is recognised when cash came in and was not all returned."""
    cancelled = status == "cancelled"
    return classify([
        (paid & cancelled, "paid_but_cancelled"),
        (paid & (refund >= amount), "paid_fully_refunded"),
        (paid, "recognized"),
        (cancelled, "cancelled_unpaid"),
    ], default="unpaid_open")


def int_orders_enriched(raw: Tables, parts: int | None = None) -> DataFrame:
    joined = fan_in(stg_orders(raw), "order_id", [payment_rollup(raw), refund_rollup(raw), shipping_rollup(raw)], parts)
    joined = fill(
        joined, zeros=["captured_usd", "gateway_fee_usd", "refund_usd", "refund_count"],
        falses=["had_duplicate_charge", "missing_ship_date"],
    )
    captured, refund, amount = F.col("captured_usd"), F.col("refund_usd"), F.col("order_amount_usd")
    paid = captured > 0
    return joined.select(
        "order_id", "customer_id", "order_status", "currency", "order_amount_usd", "created_at",
        "has_invalid_timestamp", "captured_usd", "gateway_fee_usd", "paid_at", "had_duplicate_charge",
        paid.alias("is_paid"), "refund_usd", "refund_count", "last_refund_at",
        truthy((refund >= amount) & (refund > 0)).alias("is_fully_refunded"),
        "ship_status", "shipped_at", "missing_ship_date",
        revenue_class(paid, F.col("order_status"), refund, amount).alias("revenue_classification"),
        F.when(paid, captured - refund).otherwise(F.lit(0)).alias("net_revenue_usd"),
    )


# ---- marts --------------------------------------------------------------------------

def mart_revenue(orders: DataFrame) -> DataFrame:
    return orders.drop("has_invalid_timestamp", "refund_count", "last_refund_at", "shipped_at", "missing_ship_date")


def mart_monthly_revenue(orders: DataFrame) -> DataFrame:
    """Bookings-to-net bridge; paid-but-cancelled and duplicate exposure are of-which lines, not deductions."""
    label, booked = F.col("revenue_classification"), F.col("order_amount_usd")
    return bridge(
        orders, F.col("created_at"),
        lines={
            "total_orders": row_count(),
            "gross_bookings_usd": F.sum(booked),
            "cancelled_unpaid_usd": cond_sum(label == "cancelled_unpaid", booked),
            "unpaid_open_usd": cond_sum(label == "unpaid_open", booked),
            "paid_but_cancelled_usd": cond_sum(label == "paid_but_cancelled", F.col("captured_usd")),
            "duplicate_charge_exposure_usd": cond_sum(F.col("had_duplicate_charge"), booked),
            "captured_cash_usd": F.sum("captured_usd"),
            "refunds_usd": F.sum("refund_usd"),
            "net_revenue_usd": F.sum("net_revenue_usd"),
            "gateway_fees_usd": F.sum("gateway_fee_usd"),
        },
        start="gross_bookings_usd", end="net_revenue_usd", gap="bookings_to_net_gap_usd", gap_pct="gap_pct",
    )


# ---- declaration for the run --------------------------------------------------------

STAGING = {
    "stg_orders": stg_orders, "stg_payments": stg_payments, "stg_refunds": stg_refunds, "stg_shipping": stg_shipping,
}
# Staging that only adds flags to its feed: same rows, same keys.
FLAGS_ONLY = {"stg_orders": "raw_orders", "stg_payments": "raw_payments", "stg_refunds": "raw_refunds", "stg_shipping": "raw_shipping"}
INTERMEDIATE = "int_orders_enriched"


def intermediate(raw: Tables, **_) -> DataFrame:
    return int_orders_enriched(raw)


def marts(inter: DataFrame, raw: Tables) -> dict[str, DataFrame]:
    return {
        "mart_revenue": mart_revenue(inter),
        "mart_monthly_revenue": mart_monthly_revenue(inter).orderBy("report_month"),
    }


CHECKS = generic_warn([
    *[check(table, key) for table, key in [
        ("stg_orders", "order_id"), ("stg_payments", "payment_id"), ("stg_refunds", "refund_id"),
        ("stg_shipping", "shipment_id"), ("int_orders_enriched", "order_id"), ("mart_revenue", "order_id"),
    ] for check in (unique, not_null)],
    not_null("int_orders_enriched", "revenue_classification"),
    accepted("int_orders_enriched", "revenue_classification", REVENUE_CLASSES),
    expression("int_orders_enriched", "net_revenue_usd <= captured_usd"),
    expression("int_orders_enriched", "refund_usd >= 0"),
    expression("mart_revenue", "order_amount_usd >= 0"),
    expression("mart_monthly_revenue", "gross_bookings_usd >= net_revenue_usd"),
    expression("mart_monthly_revenue", "captured_cash_usd >= 0"),
    tie_out_check(
        "mart_revenue", "sum(captured_usd)", "stg_payments",
        "sum(if(is_primary_record and payment_status = 'succeeded', amount_usd, 0))",
    ),
])

# Numbers whose change from run to run is watched.
HEADLINES = {"gap_pct": ("mart_monthly_revenue", "100 * sum(bookings_to_net_gap_usd) / sum(gross_bookings_usd)")}

# Loaded-at column, warn and error age in hours, and whether an error blocks.
FRESHNESS = {
    "raw_orders": ("updated_at", 36, 48, True),
    "raw_payments": ("attempted_at", 36, 48, True),
    "raw_refunds": ("requested_at", 120, 240, False),
    "raw_shipping": ("shipped_at", 48, 72, False),
}

"""Registered queries: operators and models over the benchmark tables.

A query is a function of a ``Feeds`` (session plus folder).  Results are presented with
64-bit integers and doubles, so that they can be compared with any other engine; inside the
library money stays decimal.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallywork import operators as ops
from tallywork.functions import (
    any_true, cond_count, fx_rate, in_closed_range, is_missing, max_if, n_distinct, out_of_order, pct, row_count, span,
)
from tallywork.plans import commerce, learning, metrics, rides, telecom
from tallywork.plans.pipeline import checked, freshness_report, materialise
from tallywork.session import shared_dir
from tallywork.sources.adapters import Feeds, StreamFeeds
from tallywork.sources.readers import parse_timestamps, row_counts
from tallywork.sources.writers import new_version
from tallywork.streaming import (
    arrival_counts, collect_arrivals, daily_usage, kept_rows, read_stream, replay_dedup, run_available, unmatched_within, with_end,
)

OBSERVED = {"observation_date": date(2024, 1, 30)}
ORDERS_AS_OF = "2001-08-03 12:00:00"
EVENTS_AS_OF = "2024-02-01 06:00:00"

Query = Callable[[Feeds], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as 64 bits."""
    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegralType):
            return column.cast("bigint").alias(field.name)
        return column
    return df.select(*[cast(field) for field in df.schema.fields])


# ---- shorthand for the models -------------------------------------------------------

def c_orders(f: Feeds) -> DataFrame:
    return commerce.int_orders_enriched(f.raw("commerce"))


def c_months(f: Feeds) -> DataFrame:
    return commerce.mart_monthly_revenue(c_orders(f))


def r_trips(f: Feeds) -> DataFrame:
    return rides.int_trips_enriched(f.raw("rides"))


def r_months(f: Feeds) -> DataFrame:
    return rides.mart_marketplace_kpis(r_trips(f))


def t_signals(f: Feeds) -> DataFrame:
    return telecom.int_subscriber_signals(f.raw("telecom"), **OBSERVED)


def t_churn(f: Feeds) -> DataFrame:
    return telecom.mart_subscriber_churn(t_signals(f))


def l_progress(f: Feeds) -> DataFrame:
    return learning.int_enrollment_progress(f.raw("learning"))


def l_completion(f: Feeds) -> DataFrame:
    return learning.mart_enrollment_completion(l_progress(f))


# ---- staging models -----------------------------------------------------------------

def _register_staging() -> None:
    for number, name, domain in [
        ("01", "commerce", commerce), ("02", "rides", rides), ("03", "telecom", telecom), ("09", "learning", learning),
    ]:
        for model, stage in domain.STAGING.items():
            key = f"stg_{number}_{model.removeprefix('stg_')}"
            _REGISTRY[key] = lambda f, name=name, stage=stage: stage(f.raw(name))


_register_staging()


# ---- intermediates and marts --------------------------------------------------------

@query
def int_orders_enriched(f):
    return c_orders(f)


@query
def mart_revenue(f):
    return commerce.mart_revenue(c_orders(f))


@query
def mart_monthly_revenue(f):
    return c_months(f).orderBy("report_month")


@query
def int_trips_enriched(f):
    return r_trips(f)


@query
def mart_driver_performance(f):
    return rides.mart_driver_performance(r_trips(f), f.raw("rides"))


@query
def mart_rider_activity(f):
    return rides.mart_rider_activity(r_trips(f), f.raw("rides"))


@query
def mart_marketplace_kpis(f):
    return r_months(f).orderBy("report_month")


@query
def int_subscriber_signals(f):
    return t_signals(f)


@query
def mart_subscriber_churn(f):
    return t_churn(f)


@query
def mart_churn_summary(f):
    return telecom.mart_churn_summary(t_churn(f))


@query
def int_enrollment_progress(f):
    return l_progress(f)


@query
def mart_enrollment_completion(f):
    return l_completion(f)


@query
def mart_completion_summary(f):
    return learning.mart_completion_summary(l_completion(f))


# ---- sources and row-level derivations ----------------------------------------------

@query
def parse_timestamps_query(f):
    created = F.when(F.col("order_id") % 499 == 0, "n/a").otherwise(F.col("created_at").cast("string"))
    delivered = f.commerce_orders().select("order_id", created.alias("created_at"))
    return parse_timestamps(delivered, ["created_at"])


@query
def null_sentinel(f):
    return f.raw("rides")["raw_riders"].select("rider_id", "referred_by")


@query
def row_counts_query(f):
    return row_counts({
        f"{domain}.{name}": df for domain in ("commerce", "rides", "telecom", "learning")
        for name, df in f.raw(domain).items()
    })


@query
def fx_fixed_rate(f):
    orders = commerce.stg_orders(f.raw("commerce"))
    return orders.select("order_id", "currency", fx_rate(F.col("currency")).alias("fx_rate"), "order_amount_usd")


@query
def fx_audit_rate(f):
    return r_trips(f).select(
        "trip_id", "currency", "fx_rate_to_usd", "gross_fare_usd", "captured_amount_usd", "total_incentive_usd"
    )


@query
def flag_clock_skew(f):
    """Rows stamped out of order in the three feeds that can be."""
    feeds = [
        ("orders", f.raw("commerce")["raw_orders"], "created_at", "updated_at"),
        ("trips", f.raw("rides")["raw_trips"], "requested_at", "accepted_at"),
        ("students", f.raw("learning")["raw_students"], "enrolled_at", "last_active_at"),
    ]
    parts = [
        df.agg(row_count().alias("n_rows"), cond_count(out_of_order(F.col(a), F.col(b))).alias("skewed"))
        .select(F.lit(name).alias("feed"), "n_rows", "skewed")
        for name, df, a, b in feeds
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def flag_missing(f):
    shipping = commerce.stg_shipping(f.raw("commerce"))
    return shipping.select("shipment_id", "missing_ship_date", "missing_delivery_date")


@query
def lesson_flags(f):
    lessons = learning.stg_lessons(f.raw("learning"))
    return lessons.select(
        "lesson_event_id", "enrollment_id", "lesson_number", "lesson_status", "missing_completed_at",
        "is_primary_completion",
    )


@query
def trip_classification(f):
    return rides.stg_trips(f.raw("rides")).select("trip_id", "trip_classification")


@query
def route_measure(f):
    return rides.stg_trips(f.raw("rides")).select("trip_id", "clean_revenue_fare", "cancellation_fee_amount")


@query
def revenue_classification(f):
    return c_orders(f).groupBy("revenue_classification").agg(
        row_count().alias("n_orders"), F.sum("order_amount_usd").alias("order_amount_usd"),
        F.sum("captured_usd").alias("captured_usd"),
    )


@query
def order_economics(f):
    return c_orders(f).select("order_id", "is_paid", "is_fully_refunded", "net_revenue_usd")


@query
def payout_lag(f):
    return rides.payout_lag(f.raw("rides")["raw_driver_incentives"]).select("incentive_id", "payout_lag_days")


@query
def assessment_rollup(f):
    return learning.assessment_rollup(f.raw("learning"))


@query
def churn_type(f):
    return t_churn(f).select("subscriber_id", "churn_type")


@query
def reactivated(f):
    return t_churn(f).where("is_likely_reactivated").select("subscriber_id", "disconnect_reason", "usage_events_30d")


@query
def completion_category(f):
    return l_completion(f).select("enrollment_id", "completion_category", "is_tested_out")


@query
def safe_pct(f):
    """Refunded share of captured cash per customer; NULL for customers who never paid."""
    grouped = c_orders(f).groupBy("customer_id").agg(
        F.sum("refund_usd").alias("refund_usd"), F.sum("captured_usd").alias("captured_usd")
    )
    return grouped.withColumn("refund_pct", pct(F.col("refund_usd"), F.col("captured_usd")))


@query
def guarded_pct(f):
    drivers = rides.mart_driver_performance(r_trips(f), f.raw("rides"))
    return drivers.select("driver_id", "completion_rate_pct", "fraud_rate_pct")


# ---- filters ------------------------------------------------------------------------

@query
def usage_window_30d(f):
    """Thirty days up to the midnight that starts the last of them: usage of that day itself is outside."""
    usage = telecom.stg_usage(f.raw("telecom"))
    return usage.where(in_closed_range(F.col("usage_date"), "2023-12-30", "2024-01-29")).groupBy("subscriber_id").agg(
        row_count().alias("usage_events"), F.sum("usage_units").alias("usage_units")
    )


@query
def active_riders(f):
    riders = rides.mart_rider_activity(r_trips(f), f.raw("rides"))
    flags = ["is_active_crm", "is_active_requested_30d", "is_active_completed_30d", "is_active_clean_30d"]
    return riders.agg(row_count().alias("riders"), *[cond_count(F.col(c)).alias(c.removeprefix("is_")) for c in flags])


# ---- joins and aggregations ---------------------------------------------------------

@query
def incentive_flags(f):
    lines = rides.stg_driver_incentives(f.raw("rides"))
    return lines.select("incentive_id", "trip_id", "is_fraud_trip", "campaign_lines_per_trip", "is_multi_campaign")


@query
def payment_rollup(f):
    return commerce.payment_rollup(f.raw("commerce"))


@query
def capture_rollup(f):
    return rides.payment_rollup(f.raw("rides"))


@query
def trip_counts(f):
    stats = rides.trip_stats_by_driver(r_trips(f))
    return stats.select("driver_id", "total_trips", "completed_trips", "cancelled_trips", "fraud_trips", "clean_completed_trips")


@query
def refund_rollup(f):
    return commerce.refund_rollup(f.raw("commerce"))


@query
def distinct_counts(f):
    return f.table("lineitem").groupBy("l_suppkey").agg(
        n_distinct(F.col("l_orderkey")).alias("orders"), n_distinct(F.col("l_partkey")).alias("parts"), row_count().alias("lines")
    )


@query
def lesson_rollup(f):
    return learning.lesson_rollup(f.raw("learning"))


@query
def lesson_rollup_by_status(f):
    return learning.lesson_rollup(f.raw("learning"), partition_by_status=True)


@query
def first_last_activity(f):
    return f.raw("rides")["raw_trips"].groupBy("rider_id").agg(*span(F.col("requested_at"), "first_trip_at", "last_trip_at"))


@query
def conditional_extreme(f):
    stats = rides.trip_stats_by_rider(r_trips(f))
    return stats.select("rider_id", "last_completed_at", "last_clean_completed_at")


@query
def bool_or_rollup(f):
    return f.raw("rides")["raw_trips"].groupBy("driver_id").agg(
        any_true(F.col("is_fraud_flagged")).alias("had_fraud"),
        any_true(is_missing(F.col("ended_at"))).alias("had_unfinished"),
    )


@query
def shipping_rollup(f):
    return commerce.shipping_rollup(f.raw("commerce"))


@query
def driver_incentives(f):
    return rides.incentives_by_driver(f.raw("rides"))


@query
def last_past_due(f):
    payments = f.raw("telecom")["raw_payments"]
    return payments.groupBy("subscriber_id").agg(
        max_if(F.col("payment_status") == "past_due", F.col("due_at")).alias("last_past_due_at")
    )


@query
def take_rate(f):
    return r_months(f).select("report_month", "take_rate_pct", "gmv_to_net_gap_pct")


@query
def net_after_fraud(f):
    return rides.net_after_fraud(r_months(f)).select("report_month", "net_revenue_usd", "fraud_fare_usd", "net_after_fraud_usd")


@query
def refunds_by_month(f):
    return metrics.refunds_by_month(f.raw("commerce"))


# ---- dedup --------------------------------------------------------------------------

@query
def dedup_latest(f):
    return ops.dedup_latest(
        f.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], count_col="copies", flag_col="is_duplicated"
    )


@query
def dedup_priority(f):
    return telecom.stg_payments(f.raw("telecom")).select("payment_id", "subscriber_id", "billing_period", "payment_status")


@query
def dedup_business_key(f):
    return telecom.stg_usage(f.raw("telecom"))


@query
def flag_primary(f):
    payments = rides.stg_payments(f.raw("rides"))
    return payments.select(
        "payment_id", "trip_id", "payment_status", "captures_per_trip", "is_duplicate_capture", "is_primary_record"
    )


# ---- definitions --------------------------------------------------------------------

@query
def churn_definitions(f):
    return t_churn(f).select("subscriber_id", *telecom.CHURN_FLAGS)


@query
def completion_definitions(f):
    return l_completion(f).select("enrollment_id", *learning.COMPLETION_FLAGS)


@query
def churn_overlap(f):
    return telecom.mart_churn_summary(t_churn(f)).select("total_subscribers", "churned_any", "churned_all_three")


@query
def overlap_matrix(f):
    return ops.overlap_matrix(t_churn(f), telecom.CHURN_FLAGS)


@query
def definition_spread(f):
    return ops.definition_spread(t_churn(f), "is_churned_explicit", "is_churned_no_usage")


# ---- bridges and tie-outs -----------------------------------------------------------

@query
def gap_ties(f):
    return ops.gap_ties(r_months(f), "gmv_usd", "net_revenue_usd", "gmv_to_net_gap_usd")


@query
def ledger_tie_out(f):
    """Mart totals against whole ledgers that are deduplicated another way.

    Payouts to drivers nobody knows are in the ledger and in no mart, so they break the tie and have a line of their own.
    """
    raw_c, raw_r = f.raw("commerce"), f.raw("rides")
    charges = commerce.stg_payments(raw_c).where("is_primary_record and payment_status = 'succeeded'")
    cash = ops.tie_out(
        commerce.mart_revenue(c_orders(f)), F.sum("captured_usd"), charges, F.sum("amount_usd")
    )
    ledger = raw_r["raw_driver_incentives"].withColumn(
        "paid_usd", F.col("bonus_amount") * fx_rate(F.col("currency"))
    )
    drivers = rides.mart_driver_performance(r_trips(f), raw_r)
    payouts = ops.tie_out(drivers, F.sum("total_incentive_paid_usd"), ledger, F.sum("paid_usd"))
    per_driver = ledger.groupBy("driver_id").agg(F.sum("paid_usd").alias("paid_usd"))
    unknown = per_driver.join(raw_r["raw_drivers"].select("driver_id"), "driver_id", "left_anti")
    orphans = ops.tie_out(unknown.limit(0), F.sum("paid_usd"), unknown, F.sum("paid_usd"))
    named = lambda df, name: df.select(F.lit(name).alias("ledger"), "*")
    return named(cash, "captured_cash").unionByName(named(payouts, "driver_incentives")).unionByName(named(orphans, "payouts_to_unknown_drivers"))


@query
def category_partition(f):
    completion = l_completion(f)
    counted = completion.agg(
        row_count().alias("total"),
        *[cond_count(F.col("completion_category") == c).alias(c) for c in learning.CATEGORIES],
    )
    return ops.partition_check(counted, "total", learning.CATEGORIES)


@query
def gap_drivers(f):
    return metrics.gap_drivers(c_months(f))


@query
def gap_trend(f):
    return ops.gap_trend(c_months(f), "report_month", "gap_pct", "2.5")


# ---- data quality -------------------------------------------------------------------

@query
def dq_unique(f):
    tables = {"lineitem": f.table("lineitem"), "orders": f.table("orders"), "events": f.table("events")}
    return ops.run_checks(tables, [
        ops.unique("lineitem", "l_orderkey", "l_linenumber", severity="warn"),
        ops.unique("orders", "o_orderkey"), ops.unique("events", "event_id"),
    ])


@query
def dq_not_null(f):
    raw = f.raw("rides")
    return ops.run_checks(raw, [
        ops.not_null("raw_trips", column) for column in ("trip_id", "cancel_reason", "is_fraud_flagged", "ended_at")
    ])


@query
def dq_accepted_values(f):
    return ops.run_checks({"events": f.table("events"), "orders": f.table("orders")}, [
        ops.accepted("events", "event_type", ["click", "view", "purchase", "signup"], severity="warn"),
        ops.accepted("orders", "o_orderstatus", ["F", "O", "P"]),
    ])


@query
def dq_expression(f):
    tables = {"int_trips_enriched": r_trips(f), "mart_churn_summary": telecom.mart_churn_summary(t_churn(f))}
    return ops.run_checks(tables, [
        ops.expression("int_trips_enriched", "accepted_at >= requested_at", severity="warn"),
        ops.expression("int_trips_enriched", "captured_amount <= gross_fare"),
        telecom.expected_lines(10000),
        ops.expression("mart_churn_summary", "churned_any >= churned_all_three"),
    ])


@query
def dq_relationships(f):
    """Orders without any line."""
    return ops.orphans(f.table("orders"), f.table("lineitem"), "o_orderkey", "l_orderkey")


@query
def dq_freshness(f):
    return (
        freshness_report(commerce, f.raw("commerce"), ORDERS_AS_OF)
        .unionByName(freshness_report(telecom, f.raw("telecom"), EVENTS_AS_OF).withColumn("source", F.concat(F.lit("telecom."), "source")))
    )


def _report(f: Feeds, domain, name: str, *extra, **options) -> DataFrame:
    """Intermediate and marts are written once, as in a gated run, and checked as written."""
    raw, checks = f.raw(name), [*domain.CHECKS, *extra]
    version = new_version("checked")
    built = materialise(f.spark, domain, raw, f"{shared_dir(f.spark)}/{name}", version, checks, **options)
    return ops.run_checks({**checked(domain, raw, checks), **built.tables}, checks, built.failures)


@query
def dq_report(f):
    return _report(f, commerce, "commerce")


@query
def dq_report_rides(f):
    return _report(f, rides, "rides")


@query
def dq_report_telecom(f):
    return _report(f, telecom, "telecom", telecom.expected_lines(10000), **OBSERVED)


@query
def dq_report_learning(f):
    return _report(f, learning, "learning")


@query
def run_trend(f):
    """Gap of the bookings from one year's close to the next, as a history of runs would hold it."""
    years = c_months(f).groupBy(F.year("report_month").alias("year")).agg(
        (F.sum("bookings_to_net_gap_usd") * 100 / F.sum("gross_bookings_usd")).cast("double").alias("value")
    )
    history = years.select(F.concat(F.lit("close-"), "year").alias("run"), F.make_date("year", F.lit(12), F.lit(31)).alias("ended_at"), F.lit("gap_pct").alias("subject"), F.round("value", 6).alias("value"))
    trend = ops.run_trend(history, "gap_pct", "0.5")
    return trend.withColumn("change", F.round("change", 6))


@query
def profile_table(f):
    return ops.profile(f.raw("commerce")["raw_payments"], ["order_id"])


@query
def profile_merged(f):
    """Sketches kept per month of shipping, merged into the profile of the whole table."""
    lines = f.table("lineitem").select(
        F.date_trunc("month", "l_shipdate").alias("ship_month"), "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
    )
    report = ops.sketch_report(ops.sketch(lines, by=["ship_month"]))
    return report.select("column_name", "rows", "nulls", "distinct_estimate", *[F.round(q, 4).alias(q) for q in ("q50", "q95", "q99")])


@query
def value_counts(f):
    return ops.value_counts(f.table("events"), "event_type")


@query
def dup_keys(f):
    return ops.dup_keys(f.table("lineitem"), ["l_orderkey", "l_linenumber"])


# ---- metrics of the written definitions ---------------------------------------------

@query
def refund_rate(f):
    return metrics.refund_rate(c_months(f))


@query
def recognized_revenue(f):
    return metrics.recognized_revenue(c_orders(f))


@query
def cancellation_rate(f):
    return metrics.cancellation_rate(r_months(f))


@query
def cross_month_refunds(f):
    return metrics.cross_month_refunds(f.raw("commerce"))


@query
def churn_split(f):
    return metrics.churn_split(t_churn(f))


@query
def person_completion(f):
    return metrics.person_completion(l_completion(f))


@query
def active_learners(f):
    return metrics.active_learners(learning.stg_students(f.raw("learning")))


@query
def learning_engagement(f):
    return metrics.learning_engagement(l_progress(f))


@query
def pass_rate(f):
    return metrics.pass_rate(f.raw("learning"))


@query
def trip_distance(f):
    return metrics.trip_distance(f.raw("rides")["raw_trips"])


@query
def incentive_exposure(f):
    return metrics.incentive_exposure(f.raw("rides"))


@query
def uncaptured_trips(f):
    return metrics.uncaptured_trips(f.raw("rides"))


@query
def status_contradictions(f):
    return metrics.status_contradictions(c_orders(f))


@query
def fx_asof(f):
    return metrics.fx_asof(f.raw("commerce"), f.fx_quotes())


@query
def ops_findings(f):
    return metrics.ops_findings(f.raw("commerce"))


@query
def payout_findings(f):
    return metrics.payout_findings(f.raw("rides"))


@query
def ticket_backlog(f):
    return metrics.ticket_backlog(f.raw("telecom"))


# ---- streams ------------------------------------------------------------------------

def _usage_stream(f: Feeds) -> DataFrame:
    events = read_stream(f.spark, f.folder, f.table("events").schema, pattern="events.parquet", maxFilesPerTrigger=16)
    return events.where("event_type <> 'error'").select(
        F.col("user_id").alias("subscriber_id"), F.col("event_type").alias("usage_type"),
        F.round(F.col("value") / 10).cast("decimal(14,3)").alias("usage_units"),
        F.col("ts").alias("usage_date"), F.col("ts").cast("date").alias("usage_day"),
    )


def _stream_folder(f: Feeds, name: str) -> str:
    """A folder of its own for each call: a registered query starts from the beginning of the stream."""
    return f"{shared_dir(f.spark)}/streams/{new_version(name)}"


_USAGE_KEY = ["subscriber_id", "usage_day", "usage_type", "usage_units"]


def _arrivals(f: Feeds, name: str) -> str:
    """Usage in four arrivals: by day, and some of every day with the last one."""
    folder = _stream_folder(f, name)
    usage = f.raw("telecom")["raw_usage"].withColumn("usage_day", F.col("usage_date").cast("date"))
    usage.withColumn("part", F.expr("if(usage_id % 17 = 3, 3, dayofmonth(usage_day) DIV 8)")).write.partitionBy("part").parquet(f"{folder}/feed")
    stream = read_stream(f.spark, f"{folder}/feed/part=*", usage.schema, maxFilesPerTrigger=16)
    collect_arrivals(stream, folder, _USAGE_KEY, ["usage_id"], "usage_date")
    return folder


@query
def stream_replay_dedup(f):
    kept = replay_dedup(_usage_stream(f), ["subscriber_id", "usage_day", "usage_type", "usage_units"], "usage_date")
    return run_available(kept.drop("usage_date"), _stream_folder(f, "replay_dedup"))


@query
def stream_daily_usage(f):
    folder = _stream_folder(f, "daily_usage")
    usage = with_end(_usage_stream(f), "usage_date", folder, "2100-01-01 00:00:00")
    return run_available(daily_usage(usage, "usage_date", "usage_type", "usage_units"), folder)


@query
def stream_first_rows(f):
    """The earliest usage row of every business key, whatever order the rows arrive in."""
    folder = _arrivals(f, "first_rows")
    return kept_rows(f.spark, folder, _USAGE_KEY, ["usage_id"]).drop("usage_date")


@query
def stream_arrival_counts(f):
    """All arrivals: kept and replayed ones add up to the input, the late ones included."""
    counts = arrival_counts(f.spark, _arrivals(f, "counts"), _USAGE_KEY)
    total = counts.agg(*[F.sum(c).alias(c) for c in ("n_input", "n_kept", "n_replay")])
    return total.withColumn("balances", F.col("n_input") == F.col("n_kept") + F.col("n_replay"))


@query
def stream_uncaptured(f):
    """Fares of the trip stream whose capture has not come within two days."""
    folder = _stream_folder(f, "uncaptured")
    raw = StreamFeeds(f.spark, f.folder).raw("rides")
    fares = raw["raw_trips"].where("gross_fare > 0").select("trip_id", "trip_status", "gross_fare", "currency", "requested_at")
    captures = raw["raw_payments"].where("payment_status = 'captured'").select("trip_id", "attempted_at")
    fares = with_end(fares, "requested_at", f"{folder}/due", "2100-01-01 00:00:00")
    captures = with_end(captures, "attempted_at", f"{folder}/done", "2100-01-01 00:00:00")
    return run_available(unmatched_within(fares, captures, "trip_id", "requested_at", "attempted_at", "2 days"), folder).where("trip_id IS NOT NULL").drop("requested_at")


# ---- history, restatements and line matches -----------------------------------------

_TAKEN = [datetime(1996, 7, 1), datetime(1998, 7, 1), datetime(2001, 9, 1)]


def _trip_snapshots(f: Feeds) -> dict[datetime, DataFrame]:
    """The trips as three runs kept them: requested by then, flags set up to 900 days after the trip, some cleared at last."""
    trips = f.raw("rides")["raw_trips"]
    known = "is_fraud_flagged AND date_add(CAST(requested_at AS date), CAST(trip_id % 900 AS int)) <= CAST(taken AS date) AND NOT (last AND trip_id % 217 = 0)"

    def at(i: int, taken: datetime) -> DataFrame:
        rows = trips.where(F.col("requested_at") < F.lit(taken).cast("timestamp_ntz"))
        marked = rows.withColumns({"taken": F.lit(taken).cast("timestamp_ntz"), "last": F.lit(i == len(_TAKEN) - 1)})
        return marked.withColumn("is_fraud_flagged", F.expr(known)).drop("taken", "last")

    return {taken: at(i, taken) for i, taken in enumerate(_TAKEN)}


@query
def flag_validity(f):
    """Since when, and until when, the kept snapshots show which flag and status on each trip."""
    return ops.validity(_trip_snapshots(f), ["trip_id"], ["trip_status", "is_fraud_flagged"])


@query
def fraud_reversals(f):
    """GMV to net, with fraud fares reversed in the month the flag was set."""
    trips = r_trips(f)
    events = ops.flag_events(_trip_snapshots(f), ["trip_id"], "is_fraud_flagged")
    return rides.net_after_reversals(rides.mart_marketplace_kpis(trips), rides.fraud_reversals(trips, events))


def _earlier_close(f: Feeds) -> dict[str, DataFrame]:
    """The commerce feeds as an earlier run saw them: orders that came late are missing, amounts, states and dates are not yet corrected."""
    raw = dict(f.raw("commerce"))
    raw["raw_orders"] = raw["raw_orders"].where("order_id % 29 <> 3").withColumns({
        "order_status": F.expr("if(order_id % 43 = 7, 'cancelled', order_status)"),
        "created_at": F.expr("if(order_id % 53 = 9, created_at - INTERVAL 40 DAYS, created_at)"),
    })
    raw["raw_payments"] = raw["raw_payments"].withColumn("amount", F.expr("if(order_id % 37 = 5, CAST(amount * 0.9 AS decimal(12,2)), amount)"))
    raw["raw_refunds"] = raw["raw_refunds"].where("processed_at < timestamp_ntz'2000-12-01'")
    return raw


@query
def restatement_bridge(f):
    """Why recognised revenue of each month differs from what the close of November 2000 said."""
    later = dict(f.raw("commerce"))
    later["raw_orders"] = later["raw_orders"].where("order_id % 41 <> 11")
    # Both runs meet in one task per partition, so a partition must not grow with the tables.
    runs = [commerce.int_orders_enriched(raw, f.parts("orders")) for raw in (_earlier_close(f), later)]
    kind = F.col("revenue_classification")
    return ops.restated(*runs, ["order_id"], F.date_trunc("month", "created_at").cast("timestamp_ntz"), kind, F.col("net_revenue_usd"), kind == "recognized", F.lit(datetime(2000, 11, 1)).cast("timestamp_ntz"))


def _bank(f: Feeds) -> tuple[DataFrame, DataFrame]:
    """Captured charges, and a bank's statement of them: some booked days off, some missing, charged twice or short.  Amounts are whole
    fifty-thousands, so that many lines share key and amount."""
    whole = "CAST(ceil(amount / 50000) * 50000 AS decimal(12,2))"
    paid = f.raw("commerce")["raw_payments"].where("payment_status = 'succeeded'").selectExpr("payment_id", "payment_method", f"{whole} AS amount", "CAST(processed_at AS date) AS day")
    charges = paid.selectExpr("payment_id AS line_id", "payment_method AS key", "amount", "day")
    shift = "CASE payment_id % 10 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN -1 WHEN 3 THEN 9 ELSE 0 END"
    lines = paid.where("payment_id % 53 <> 3").selectExpr(
        "inline(array_compact(array(struct(payment_id * 3 AS line_id), if(payment_id % 61 = 8, struct(payment_id * 3 + 1 AS line_id), NULL))))", "payment_method AS key",
        "amount - if(payment_id % 59 = 4, 1, 0) AS amount", f"date_add(day, {shift}) AS day",
    )
    return charges, lines


@query
def ledger_match_lines(f):
    return ops.match_lines(*_bank(f), days=2)


@query
def ledger_match(f):
    return ops.match_summary(ops.match_lines(*_bank(f), days=2))


@query
def trailing_active_riders(f):
    """Riders with a completed trip on a day, and in the 7 and 28 days up to it."""
    done = f.raw("rides")["raw_trips"].where("trip_status = 'completed'")
    return ops.trailing_actives(done, "rider_id", "requested_at", [1, 7, 28])


@query
def robust_gap_trend(f):
    return ops.robust_trend(c_months(f), "report_month", "gap_pct")


@query
def fx_restated(f):
    """Orders of each month at the rates a close of mid-1998 knew, and at those known by now."""
    quotes = f.fx_quotes().withColumn("known_on", F.date_add("rate_date", 1))
    corrected = quotes.where(F.dayofmonth("rate_date") % 5 == 0).select("rate_date", "currency", (F.col("rate") + F.lit("0.010").cast("decimal(6,3)")).cast("decimal(6,3)").alias("rate"), F.date_add("rate_date", 45).alias("known_on"))
    orders = f.raw("commerce")["raw_orders"].where("created_at < timestamp_ntz'1998-07-01'").select("order_id", "currency", "order_amount", "created_at")
    every = quotes.unionByName(corrected)

    def valued(as_of: str, name: str) -> DataFrame:
        priced = ops.rate_as_known(orders, every, "currency", "created_at", F.lit(as_of).cast("date"))
        return ops.by_month(priced, F.col("created_at"), {name: F.sum(F.col("order_amount") * F.col("fx_rate_to_usd"))})

    both = valued("1998-06-30", "at_close_usd").join(valued("2002-01-01", "as_known_later_usd"), "report_month")
    return both.withColumn("change_usd", F.col("as_known_later_usd") - F.col("at_close_usd"))


# ---- registry -----------------------------------------------------------------------

def _callable(function: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(function(Feeds(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name.removesuffix("_query"): _callable(function) for name, function in _REGISTRY.items()
}

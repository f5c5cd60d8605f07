"""One statement per registered query, with the same column names and types."""

from __future__ import annotations

from oracle.compose import gbp, money_ratio, pick, ratio, usd, with_parts
from oracle.feeds import FEEDS
from oracle.history import HISTORY_FINAL, HISTORY_PARTS
from oracle.models import MODELS

PARTS = {**FEEDS, **MODELS, **HISTORY_PARTS}


def _check(table: str, name: str, failures: str, source: str, severity: str = "error") -> str:
    return f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{severity}' AS severity, CAST({failures} AS BIGINT) AS failures FROM {source}"


def _rule(table: str, source: str, rule: str, severity: str = "error") -> str:
    return _check(table, f"expression({rule})", f"count(*) FILTER (WHERE NOT ({rule}))", source, severity)


def _null(table: str, source: str, column: str) -> str:
    return _check(table, f"not_null({column})", f"count(*) - count({column})", source)


def _unique(table: str, source: str, *columns: str, severity: str = "error") -> str:
    names = ", ".join(columns)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    repeated = f"(SELECT {names} FROM {source} WHERE {complete} GROUP BY {names} HAVING count(*) > 1)"
    return _check(table, f"unique({'+'.join(columns)})", "count(*)", repeated, severity)


def _accepted(table: str, source: str, column: str, values: list[str], severity: str = "error") -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return _check(table, f"accepted_values({column})", f"count(*) FILTER (WHERE {column} NOT IN ({listed}))", source, severity)


def _child(table: str, source: str, column: str, parent: str, parent_source: str) -> str:
    return _check(
        table, f"relationship({column}->{parent}.{column})", "count(*)",
        f"(SELECT 1 FROM {source} ch WHERE ch.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent_source} pa WHERE pa.{column} = ch.{column}))",
    )


def _report(*checks: str) -> str:
    lines = " UNION ALL ".join(checks)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'error' ELSE 'warn' END AS status FROM ({lines})"


def _keys(table: str, source: str, key: str) -> list[str]:
    return [_unique(table, source, key), _null(table, source, key)]


def _warn(*checks: str) -> list[str]:
    return [c.replace("'error' AS severity", "'warn' AS severity") for c in checks]


def _tie(table: str, total: str, source: str, ledger: str, ledger_total: str, ledger_source: str) -> str:
    name = f"tie_out({total}={ledger}.{ledger_total})".replace("'", "''")
    differ = f"(SELECT coalesce({total}, 0) FROM {source}) <> (SELECT coalesce({ledger_total}, 0) FROM {ledger_source})"
    return f"SELECT '{table}' AS table_name, '{name}' AS check_name, 'error' AS severity, CAST({differ} AS BIGINT) AS failures"


def _fresh(source: str, feed: str, column: str, warn: int, error: int, as_of: str, worst: str) -> str:
    return f"""
        SELECT '{source}' AS source, max({column}) AS max_loaded_at, CAST({warn} AS BIGINT) AS warn_hours, CAST({error} AS BIGINT) AS error_hours,
               CASE WHEN max({column}) + to_hours({error}) >= TIMESTAMP '{as_of}' THEN
                    if(max({column}) + to_hours({warn}) >= TIMESTAMP '{as_of}', 'pass', 'warn') ELSE '{worst}' END AS status
        FROM {feed}"""


def _sketched(column: str, number: bool) -> str:
    """What sketches tell of a whole column: registers of hashes, and the bucket of the value that has the rank, found by sorting."""
    base, registers = "ln(1.01::DOUBLE / 0.99::DOUBLE)", 2048.0
    registers_read = f"""
        SELECT CAST('0x' || md5({column}::VARCHAR)[1:8] AS BIGINT) % 2048 AS register,
               max(53 - if(CAST('0x' || md5({column}::VARCHAR)[9:21] AS BIGINT) = 0, 0, length(bin(CAST('0x' || md5({column}::VARCHAR)[9:21] AS BIGINT))))) AS zeros
        FROM lineitem WHERE {column} IS NOT NULL GROUP BY 1"""
    raw = f"{0.7213 / (1 + 1.079 / registers) * registers * registers!r}::DOUBLE / (coalesce(sum(pow(2::DOUBLE, -zeros)), 0) + 2048 - count(*))"
    distinct = f"""(SELECT CAST(round(if(count(*) < 2048 AND {raw} <= 5120, 2048::DOUBLE * ln(2048::DOUBLE / nullif(2048 - count(*), 0)), {raw})) AS BIGINT)
        FROM ({registers_read}))"""

    def at(q: str) -> str:
        if not number:
            return "NULL::DOUBLE"
        x = f"list_sort(list({column}::DOUBLE))[greatest(ceil({q}::DOUBLE * count({column}))::BIGINT, 1)]"
        return f"round(if({x} = 0, 0, exp(ceil(ln(nullif({x}, 0)) / {base}) * {base}) * 2 / (1 + 1.01::DOUBLE / 0.99::DOUBLE)), 4)"

    return f"""SELECT '{column}' AS column_name, count(*) AS rows, count(*) - count({column}) AS nulls, {distinct} AS distinct_estimate,
        {at('0.5')} AS q50, {at('0.95')} AS q95, {at('0.99')} AS q99 FROM lineitem"""


def _profile(column: str, low: str = "NULL", high: str = "NULL", mean: str = "NULL") -> str:
    return f"""
        SELECT count(*) AS "rows", count(DISTINCT order_id) AS distinct_keys, '{column}' AS column_name, count(*) - count({column}) AS nulls,
               CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value, CAST({mean} AS DOUBLE) AS avg_value
        FROM c_raw_payments"""


def _profile_id(column: str) -> str:
    return _profile(column, f"min({column})", f"max({column})", f"CAST(sum({column}) AS DOUBLE) / count({column})")


def _profile_money(column: str) -> str:
    cents = f"CAST(sum({column}) * 100 AS HUGEINT)"
    mean = f"CAST((2 * {cents} * 10000 + count({column})) // (2 * count({column})) AS DOUBLE) / 1000000"
    return _profile(column, f"min({column})", f"max({column})", mean)


_DRIVER = "driver_id:i home_city driver_status rating:d onboarded_at vehicle_class onboarding_count:i is_reonboarded"
_RIDER_COUNTS = ("total_trips_requested:i completed_trips:i clean_completed_trips:i fraud_completed_trips:i cancelled_trips:i "
                 "total_gross_fare_usd:d total_clean_revenue_usd:d total_captured_usd:d first_trip_at last_trip_at")
_SUBSCRIBER = "subscriber_id:i plan_code region account_status autopay_enrolled disconnect_reason"
_CHURN_FLAGS = "is_churned_explicit is_churned_payment_lapse is_churned_no_usage"
_DONE_FLAGS = "is_complete_platform is_complete_all_lessons is_complete_80pct_lessons is_complete_assessment"
_STUDENT = "enrollment_id:i student_id:i course_id:i plan locale enrollment_status enrolled_at last_active_at"
_TRIP = ("trip_id:i rider_id:i driver_id:i city product trip_status cancel_reason gross_fare:d surge_multiplier:d currency "
         "is_fraud_flagged requested_at accepted_at started_at ended_at trip_classification clean_revenue_fare:d cancellation_fee_amount:d")
_MONEY_LINES = ("cancelled_unpaid_usd:d unpaid_open_usd:d paid_but_cancelled_usd:d duplicate_charge_exposure_usd:d "
                "captured_cash_usd:d refunds_usd:d net_revenue_usd:d gateway_fees_usd:d bookings_to_net_gap_usd:d gap_pct")
_CLASSES = ["recognized", "paid_but_cancelled", "paid_fully_refunded", "cancelled_unpaid", "unpaid_open"]
_TRIP_CLASSES = ["clean_completed", "fraud_completed", "billed_cancellation", "zero_fare_cancellation"]
_CATEGORIES = ["passed_exam", "sat_failed_exam", "finished_lessons_no_exam", "incomplete", "other"]
_CHURN_TYPES = ["voluntary", "involuntary", "ported_out", "not_cancelled"]
_ORDERS_AS_OF, _EVENTS_AS_OF = "2001-08-03 12:00:00", "2024-02-01 06:00:00"

_RAW_NAMES = [
    ("commerce", "c", ["orders", "payments", "refunds", "shipping"]),
    ("rides", "r", ["riders", "drivers", "trips", "payments", "driver_incentives"]),
    ("telecom", "t", ["subscribers", "plans", "usage", "support_tickets", "payments"]),
    ("learning", "l", ["students", "courses", "lessons", "assessments"]),
]

_T_SUMMARY = f"""
    SELECT count(*) AS total_subscribers, count(*) FILTER (WHERE is_churned_explicit) AS churned_explicit,
           count(*) FILTER (WHERE is_churned_payment_lapse) AS churned_payment_lapse,
           count(*) FILTER (WHERE is_churned_no_usage) AS churned_no_usage,
           count(*) - count(*) FILTER (WHERE NOT is_churned_explicit AND NOT is_churned_payment_lapse AND NOT is_churned_no_usage) AS churned_any,
           count(*) FILTER (WHERE is_churned_explicit AND is_churned_payment_lapse AND is_churned_no_usage) AS churned_all_three,
           count(*) FILTER (WHERE is_likely_reactivated) AS likely_reactivated,
           {ratio('count(*) FILTER (WHERE is_churned_explicit)', 'count(*)')} AS explicit_rate_pct,
           {ratio('count(*) FILTER (WHERE is_churned_payment_lapse)', 'count(*)')} AS payment_lapse_rate_pct,
           {ratio('count(*) FILTER (WHERE is_churned_no_usage)', 'count(*)')} AS no_usage_rate_pct
    FROM t_churn"""

_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]

FINAL = {
    # ---- staging
    "stg_01_orders": pick("c_stg_orders", "order_id:i customer_id:i order_status order_amount:d currency created_at updated_at order_amount_usd:d has_invalid_timestamp"),
    "stg_01_payments": pick("c_stg_payments", "payment_id:i order_id:i payment_status amount:d currency payment_method gateway_fee:d attempted_at processed_at "
                            "amount_usd:d gateway_fee_usd:d succeeded_per_order:i is_duplicate_charge is_primary_record"),
    "stg_01_refunds": pick("c_stg_refunds", "refund_id:i order_id:i payment_id:i refund_amount:d currency refund_reason refund_status requested_at processed_at "
                           "refund_amount_usd:d refund_month"),
    "stg_01_shipping": pick("c_stg_shipping", "shipment_id:i order_id:i carrier shipping_cost:d status shipped_at delivered_at missing_ship_date missing_delivery_date"),
    "stg_02_riders": pick("r_stg_riders", "rider_id:i home_city account_status signup_at referred_by:i is_referred"),
    "stg_02_drivers": pick("r_stg_drivers", _DRIVER),
    "stg_02_trips": pick("r_stg_trips", _TRIP + " pickup_lat:d pickup_lon:d dropoff_lat:d dropoff_lon:d"),
    "stg_02_payments": pick("r_stg_payments", "payment_id:i trip_id:i rider_id:i payment_status amount:d currency payment_method processor_fee:d attempted_at captured_at "
                            "captures_per_trip:i is_duplicate_capture is_primary_record"),
    "stg_02_driver_incentives": pick("r_stg_incentives", "incentive_id:i driver_id:i trip_id:i campaign bonus_amount:d currency earned_at paid_at payout_lag_days:i "
                                     "is_fraud_trip campaign_lines_per_trip:i is_multi_campaign"),
    "stg_03_subscribers": pick("t_stg_subscribers", _SUBSCRIBER + " activated_at cancelled_at is_sim_swapped"),
    "stg_03_plans": pick("t_raw_plans", "plan_code plan_type monthly_recurring_charge:d data_allowance_gb:i contract_months:i"),
    "stg_03_usage": pick("t_stg_usage", "usage_id:i subscriber_id:i usage_type usage_units:d usage_date"),
    "stg_03_payments": pick("t_stg_payments", "payment_id:i subscriber_id:i billing_period amount_due:d payment_status payment_method due_at paid_at"),
    "stg_03_support_tickets": pick("t_stg_tickets", "ticket_id:i subscriber_id:i category channel opened_at resolved_at is_unresolved"),
    "stg_09_students": pick("l_raw_students", _STUDENT),
    "stg_09_courses": pick("l_raw_courses", "course_id:i course_title category lesson_count:i pass_threshold:i is_active created_at"),
    "stg_09_lessons": pick("l_stg_lessons", "lesson_event_id:i enrollment_id:i student_id:i course_id:i lesson_number:i lesson_type lesson_status device duration_minutes:i "
                           "started_at completed_at missing_completed_at is_primary_completion"),
    "stg_09_assessments": pick("l_stg_assessments", "assessment_attempt_id:i enrollment_id:i student_id:i course_id:i assessment_type score:i pass_threshold:i is_passed "
                               "attempt_status submitted_at graded_at is_ungraded"),
    # ---- intermediates and marts
    "int_orders_enriched": pick("c_int_orders", "order_id:i customer_id:i order_status currency order_amount_usd:d created_at has_invalid_timestamp captured_usd:d gateway_fee_usd:d "
                                "paid_at had_duplicate_charge is_paid refund_usd:d refund_count:i last_refund_at is_fully_refunded ship_status shipped_at missing_ship_date "
                                "revenue_classification net_revenue_usd:d"),
    "mart_revenue": pick("c_int_orders", "order_id:i customer_id:i order_status revenue_classification currency order_amount_usd:d captured_usd:d refund_usd:d net_revenue_usd:d "
                         "gateway_fee_usd:d is_paid is_fully_refunded had_duplicate_charge ship_status created_at paid_at"),
    "mart_monthly_revenue": pick("c_mart_months", "report_month total_orders:i gross_bookings_usd:d " + _MONEY_LINES),
    "int_trips_enriched": pick("r_int_trips", _TRIP + " fx_rate_to_usd:d gross_fare_usd:d clean_revenue_fare_usd:d cancellation_fee_usd:d captured_amount:d processor_fee:d "
                               "payment_method captured_at captures_per_trip:i had_duplicate_capture captured_amount_usd:d processor_fee_usd:d total_incentive_amount:d "
                               "incentive_line_count:i is_multi_campaign total_incentive_usd:d"),
    "mart_driver_performance": pick("r_mart_drivers", _DRIVER + " total_trips:i completed_trips:i cancelled_trips:i fraud_trips:i clean_completed_trips:i completion_rate_pct:d "
                                    "fraud_rate_pct:d gross_fare_usd:d clean_revenue_usd:d total_captured_usd:d total_processor_fees_usd:d total_incentive_paid_usd:d "
                                    "fraud_trip_incentive_usd:d multi_campaign_incentive_usd:d total_incentive_lines:i trips_with_incentives:i "
                                    "duplicate_capture_exposure_usd:d first_trip_at last_trip_at"),
    "mart_rider_activity": pick("r_mart_riders", "rider_id:i home_city account_status signup_at is_referred " + _RIDER_COUNTS +
                                " is_active_crm is_active_requested_30d is_active_completed_30d is_active_clean_30d"),
    "mart_marketplace_kpis": pick("r_mart_months", "report_month total_trips:i completed_trips:i cancelled_trips:i clean_completed_trips:i fraud_completed_trips:i "
                                  "billed_cancellation_trips:i zero_fare_cancellation_trips:i completion_rate_pct fraud_rate_pct gmv_usd:d zero_fare_cancel_usd:d fraud_fare_usd:d "
                                  "cancellation_fee_revenue_usd:d clean_trip_revenue_usd:d total_captured_usd:d total_processor_fees_usd:d net_revenue_usd:d "
                                  "duplicate_capture_exposure_usd:d total_incentive_spend_usd:d fraud_incentive_spend_usd:d take_rate_pct:d gmv_to_net_gap_usd:d gmv_to_net_gap_pct:d"),
    "int_subscriber_signals": pick("t_signals", _SUBSCRIBER + " activated_at cancelled_at is_sim_swapped usage_events_30d:i usage_units_30d:d last_usage_at lifetime_usage_events:i "
                                   "past_due_periods:i failed_periods:i last_past_due_at ticket_count:i unresolved_tickets:i"),
    "mart_subscriber_churn": pick("t_churn", _SUBSCRIBER + " is_sim_swapped usage_events_30d:i usage_units_30d:d last_usage_at past_due_periods:i ticket_count:i unresolved_tickets:i "
                                  + _CHURN_FLAGS + " churn_type is_likely_reactivated"),
    "mart_churn_summary": _T_SUMMARY,
    "int_enrollment_progress": pick("l_progress", _STUDENT + " course_title category lesson_count:i pass_threshold:i lessons_completed:i last_lesson_at pct_lessons_completed "
                                    "assessment_attempts:i ungraded_attempts:i passed_assessment best_score:i last_graded_at sat_assessment"),
    "mart_enrollment_completion": pick("l_completion", _STUDENT + " course_title category lesson_count:i lessons_completed:i last_lesson_at pct_lessons_completed "
                                       "assessment_attempts:i passed_assessment best_score:i sat_assessment " + _DONE_FLAGS + " completion_category is_tested_out"),
    "mart_completion_summary": "SELECT * FROM l_summary",
    # ---- sources and row-level derivations
    "parse_timestamps": """
        SELECT order_id, CASE WHEN order_id % 499 > 0 THEN created_at END AS created_at, order_id % 499 = 0 AS created_at_unparsed FROM c_raw_orders""",
    "null_sentinel": pick("r_raw_riders", "rider_id referred_by:i"),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{domain}.raw_{name}' AS table_name, count(*) AS n_rows FROM {prefix}_raw_{name}" for domain, prefix, names in _RAW_NAMES for name in names
    ),
    "fx_fixed_rate": f"SELECT order_id, currency, CAST({usd('1.00')} AS DOUBLE) AS fx_rate, CAST(order_amount_usd AS DOUBLE) AS order_amount_usd FROM c_stg_orders",
    "fx_audit_rate": pick("r_int_trips", "trip_id:i currency fx_rate_to_usd:d gross_fare_usd:d captured_amount_usd:d total_incentive_usd:d"),
    "flag_clock_skew": """
        SELECT 'orders' AS feed, count(*) AS n_rows, count(*) FILTER (WHERE updated_at < created_at) AS skewed FROM c_raw_orders
        UNION ALL SELECT 'trips', count(*), count(*) FILTER (WHERE accepted_at < requested_at) FROM r_raw_trips
        UNION ALL SELECT 'students', count(*), count(*) FILTER (WHERE last_active_at < enrolled_at) FROM l_raw_students""",
    "flag_missing": pick("c_stg_shipping", "shipment_id:i missing_ship_date missing_delivery_date"),
    "lesson_flags": pick("l_stg_lessons", "lesson_event_id:i enrollment_id:i lesson_number:i lesson_status missing_completed_at is_primary_completion"),
    "trip_classification": pick("r_stg_trips", "trip_id:i trip_classification"),
    "route_measure": pick("r_stg_trips", "trip_id:i clean_revenue_fare:d cancellation_fee_amount:d"),
    "revenue_classification": """
        SELECT revenue_classification, count(*) AS n_orders, CAST(sum(order_amount_usd) AS DOUBLE) AS order_amount_usd,
               CAST(sum(captured_usd) AS DOUBLE) AS captured_usd
        FROM c_int_orders GROUP BY revenue_classification""",
    "order_economics": pick("c_int_orders", "order_id:i is_paid is_fully_refunded net_revenue_usd:d"),
    "payout_lag": "SELECT incentive_id, CAST(CAST(paid_at AS DATE) - CAST(earned_at AS DATE) AS BIGINT) AS payout_lag_days FROM r_raw_driver_incentives",
    "assessment_rollup": pick("l_outcomes", "enrollment_id:i total_attempts:i ungraded_attempts:i ever_passed best_score:i first_attempt_at last_graded_at"),
    "churn_type": pick("t_churn", "subscriber_id:i churn_type"),
    "reactivated": pick("t_churn", "subscriber_id:i disconnect_reason usage_events_30d:i", "is_churned_explicit AND NOT is_churned_no_usage"),
    "completion_category": pick("l_completion", "enrollment_id:i completion_category is_tested_out"),
    "safe_pct": f"""
        SELECT customer_id, CAST(refund AS DOUBLE) AS refund_usd, CAST(captured AS DOUBLE) AS captured_usd, {money_ratio('refund', 'captured')} AS refund_pct
        FROM (SELECT customer_id, sum(refund_usd) AS refund, sum(captured_usd) AS captured FROM c_int_orders GROUP BY customer_id)""",
    "guarded_pct": pick("r_mart_drivers", "driver_id:i completion_rate_pct:d fraud_rate_pct:d"),
    # ---- filters
    "usage_window_30d": """
        SELECT subscriber_id, count(*) AS usage_events, CAST(sum(usage_units) AS DOUBLE) AS usage_units
        FROM t_stg_usage WHERE usage_date BETWEEN TIMESTAMP '2023-12-30' AND TIMESTAMP '2024-01-29' GROUP BY subscriber_id""",
    "active_riders": """
        SELECT count(*) AS riders, count(*) FILTER (WHERE is_active_crm) AS active_crm, count(*) FILTER (WHERE is_active_requested_30d) AS active_requested_30d,
               count(*) FILTER (WHERE is_active_completed_30d) AS active_completed_30d, count(*) FILTER (WHERE is_active_clean_30d) AS active_clean_30d
        FROM r_mart_riders""",
    # ---- joins and aggregations
    "incentive_flags": pick("r_stg_incentives", "incentive_id:i trip_id:i is_fraud_trip campaign_lines_per_trip:i is_multi_campaign"),
    "payment_rollup": pick("c_cash", "order_id:i captured_usd:d gateway_fee_usd:d succeeded_per_order:i had_duplicate_charge paid_at"),
    "capture_rollup": """
        SELECT trip_id, CAST(captured_amount AS DOUBLE) AS captured_amount, CAST(processor_fee AS DOUBLE) AS processor_fee, payment_method,
               captured_at, captures_per_trip, had_duplicate_capture, currency AS payment_currency
        FROM r_cash JOIN r_raw_trips USING (trip_id)""".replace("captured_at, captures", "r_cash.captured_at, captures"),
    "trip_counts": pick("r_by_driver", "driver_id:i total_trips:i completed_trips:i cancelled_trips:i fraud_trips:i clean_completed_trips:i"),
    "refund_rollup": pick("c_back", "order_id:i refund_usd:d refund_count:i last_refund_at"),
    "distinct_counts": """
        SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(*) AS lines FROM lineitem GROUP BY l_suppkey""",
    "lesson_rollup": pick("l_studied", "enrollment_id:i lessons_completed:i last_lesson_at"),
    "lesson_rollup_by_status": """
        SELECT enrollment_id, count(DISTINCT lesson_number) FILTER (WHERE lesson_status = 'completed') AS lessons_completed,
               max(coalesce(completed_at, started_at)) AS last_lesson_at
        FROM l_raw_lessons GROUP BY enrollment_id""",
    "first_last_activity": "SELECT rider_id, min(requested_at) AS first_trip_at, max(requested_at) AS last_trip_at FROM r_raw_trips GROUP BY rider_id",
    "conditional_extreme": pick("r_by_rider", "rider_id:i last_completed_at last_clean_completed_at"),
    "bool_or_rollup": """
        SELECT driver_id, count(*) FILTER (WHERE is_fraud_flagged) > 0 AS had_fraud, count(ended_at) < count(*) AS had_unfinished
        FROM r_raw_trips GROUP BY driver_id""",
    "shipping_rollup": pick("c_parcels", "order_id:i ship_status shipped_at missing_ship_date"),
    "driver_incentives": pick("r_payouts", "driver_id:i total_incentive_paid_usd:d fraud_trip_incentive_usd:d multi_campaign_incentive_usd:d total_incentive_lines:i trips_with_incentives:i"),
    "last_past_due": pick("t_paid", "subscriber_id:i last_past_due_at"),
    "take_rate": pick("r_mart_months", "report_month take_rate_pct:d gmv_to_net_gap_pct:d"),
    "net_after_fraud": """
        SELECT report_month, CAST(net_revenue_usd AS DOUBLE) AS net_revenue_usd, CAST(fraud_fare_usd AS DOUBLE) AS fraud_fare_usd,
               CAST(net_revenue_usd - fraud_fare_usd AS DOUBLE) AS net_after_fraud_usd
        FROM r_mart_months""",
    "refunds_by_month": """
        SELECT refund_month, count(*) AS refunds, CAST(sum(refund_amount_usd) AS DOUBLE) AS refunds_in_month_usd FROM c_stg_refunds GROUP BY refund_month""",
    # ---- dedup
    "dedup_latest": f"""
        SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber), copies > 1 AS is_duplicated FROM (
            SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(f'{c} DESC NULLS FIRST' for c in _LINE_ORDER)}) = 1)""",
    "dedup_priority": pick("t_stg_payments", "payment_id:i subscriber_id:i billing_period payment_status"),
    "dedup_business_key": pick("t_stg_usage", "usage_id:i subscriber_id:i usage_type usage_units:d usage_date"),
    "flag_primary": pick("r_stg_payments", "payment_id:i trip_id:i payment_status captures_per_trip:i is_duplicate_capture is_primary_record"),
    # ---- definitions
    "churn_definitions": pick("t_churn", "subscriber_id:i " + _CHURN_FLAGS),
    "completion_definitions": pick("l_completion", "enrollment_id:i " + _DONE_FLAGS),
    "churn_overlap": f"SELECT total_subscribers, churned_any, churned_all_three FROM ({_T_SUMMARY})",
    "overlap_matrix": f"SELECT {', '.join(_CHURN_FLAGS.split())}, count(*) AS n FROM t_churn GROUP BY ALL",
    "definition_spread": """
        SELECT in_a, in_a - in_both AS only_a, in_both, in_b - in_both AS only_b, in_b, in_b - in_a AS spread
        FROM (SELECT count(*) FILTER (WHERE is_churned_explicit) AS in_a, count(*) FILTER (WHERE is_churned_no_usage) AS in_b,
                     count(*) FILTER (WHERE is_churned_explicit AND is_churned_no_usage) AS in_both FROM t_churn)""",
    # ---- bridges and tie-outs
    "gap_ties": """
        SELECT report_month, CAST(round(gmv_usd - net_revenue_usd, 2) AS DOUBLE) AS expected_gap,
               CAST(round(gmv_to_net_gap_usd, 2) AS DOUBLE) AS stated_gap, true AS ties
        FROM r_mart_months""",
    "ledger_tie_out": f"""
        SELECT ledger, CAST(mart AS DOUBLE) AS mart_total, CAST(total AS DOUBLE) AS ledger_total, CAST(coalesce(mart, 0) - coalesce(total, 0) AS DOUBLE) AS difference, coalesce(mart, 0) = coalesce(total, 0) AS ties
        FROM (
            SELECT 'captured_cash' AS ledger, (SELECT sum(captured_usd) FROM c_int_orders) AS mart, sum(amount_usd) AS total FROM c_stg_payments WHERE is_primary_record AND payment_status = 'succeeded'
            UNION ALL
            SELECT 'driver_incentives', sum({gbp('bonus_amount')}) FILTER (WHERE driver_id IN (SELECT s_suppkey FROM supplier)), sum({gbp('bonus_amount')}) FROM r_raw_driver_incentives
            UNION ALL
            SELECT 'payouts_to_unknown_drivers', NULL, sum({gbp('bonus_amount')}) FROM r_raw_driver_incentives WHERE driver_id NOT IN (SELECT s_suppkey FROM supplier))""",
    "category_partition": "SELECT count(*) AS total, count(completion_category) AS parts_sum, count(*) = count(completion_category) AS partitions FROM l_completion",
    "gap_drivers": f"""
        SELECT report_month, driver, CAST(amount AS DOUBLE) AS amount, {money_ratio('amount', 'gap')} AS share_of_gap_pct,
               row_number() OVER (PARTITION BY report_month ORDER BY amount DESC, driver) AS driver_rank
        FROM (
            SELECT report_month, bookings_to_net_gap_usd AS gap, unnest(['cancelled_unpaid_usd', 'unpaid_open_usd', 'refunds_usd', 'paid_but_cancelled_usd', 'duplicate_charge_exposure_usd']) AS driver,
                   unnest([cancelled_unpaid_usd, unpaid_open_usd, refunds_usd, paid_but_cancelled_usd, duplicate_charge_exposure_usd]) AS amount
            FROM c_mart_months)""",
    "gap_trend": """
        SELECT now.report_month, now.gap_pct, before.gap_pct AS previous_gap_pct, round(now.gap_pct - before.gap_pct, 2) AS change_points,
               coalesce(abs(round(now.gap_pct - before.gap_pct, 2)) > 2.5, false) AS is_anomaly
        FROM c_mart_months now LEFT JOIN c_mart_months before ON before.report_month = (
            SELECT max(report_month) FROM c_mart_months earlier WHERE earlier.report_month < now.report_month)""",
    "run_trend": """
        SELECT run, ended_at, round(value, 6) AS value, round(before, 6) AS previous_value, round(round(value, 6) - round(before, 6), 6) AS change,
               coalesce(abs(round(value, 6) - round(before, 6)) > 0.5, false) AS is_anomaly
        FROM (SELECT *, lag(value) OVER (ORDER BY ended_at) AS before FROM (
            SELECT 'close-' || year(report_month) AS run, make_date(year(report_month), 12, 31) AS ended_at,
                   CAST(sum(bookings_to_net_gap_usd) * 100 AS DOUBLE) / CAST(sum(gross_bookings_usd) AS DOUBLE) AS value
            FROM c_mart_months GROUP BY year(report_month)))""",
    # ---- data quality
    "dq_unique": _report(
        _unique("lineitem", "lineitem", "l_orderkey", "l_linenumber", severity="warn"),
        _unique("orders", "orders", "o_orderkey"), _unique("events", "events", "event_id"),
    ),
    "dq_not_null": _report(*[_null("raw_trips", "r_raw_trips", c) for c in ("trip_id", "cancel_reason", "is_fraud_flagged", "ended_at")]),
    "dq_accepted_values": _report(
        _accepted("events", "events", "event_type", ["click", "view", "purchase", "signup"], "warn"),
        _accepted("orders", "orders", "o_orderstatus", ["F", "O", "P"]),
    ),
    "dq_expression": _report(
        _rule("int_trips_enriched", "r_int_trips", "accepted_at >= requested_at", "warn"),
        _rule("int_trips_enriched", "r_int_trips", "captured_amount <= gross_fare"),
        _rule("mart_churn_summary", f"({_T_SUMMARY})", "total_subscribers = 10000"),
        _rule("mart_churn_summary", f"({_T_SUMMARY})", "churned_any >= churned_all_three"),
    ),
    "dq_relationships": """
        SELECT o_orderkey AS orphan_key, count(*) AS n_rows FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey""",
    "dq_freshness": " UNION ALL ".join([
        _fresh("raw_orders", "c_raw_orders", "updated_at", 36, 48, _ORDERS_AS_OF, "error"),
        _fresh("raw_payments", "c_raw_payments", "attempted_at", 36, 48, _ORDERS_AS_OF, "error"),
        _fresh("raw_refunds", "c_raw_refunds", "requested_at", 120, 240, _ORDERS_AS_OF, "warn"),
        _fresh("raw_shipping", "c_raw_shipping", "shipped_at", 48, 72, _ORDERS_AS_OF, "warn"),
        _fresh("telecom.raw_usage", "t_raw_usage", "usage_date", 36, 48, _EVENTS_AS_OF, "error"),
        _fresh("telecom.raw_payments", "t_raw_payments", "due_at", 36, 48, _EVENTS_AS_OF, "error"),
        _fresh("telecom.raw_subscribers", "t_raw_subscribers", "activated_at", 48, 72, _EVENTS_AS_OF, "warn"),
        _fresh("telecom.raw_support_tickets", "t_raw_support_tickets", "opened_at", 120, 240, _EVENTS_AS_OF, "warn"),
    ]),
    "dq_report": _report(
        *_warn(*_keys("stg_orders", "c_stg_orders", "order_id")), *_warn(*_keys("stg_payments", "c_stg_payments", "payment_id")),
        *_warn(*_keys("stg_refunds", "c_stg_refunds", "refund_id")), *_warn(*_keys("stg_shipping", "c_stg_shipping", "shipment_id")),
        *_warn(*_keys("int_orders_enriched", "c_int_orders", "order_id")), *_warn(*_keys("mart_revenue", "c_int_orders", "order_id")),
        *_warn(_null("int_orders_enriched", "c_int_orders", "revenue_classification")),
        *_warn(_accepted("int_orders_enriched", "c_int_orders", "revenue_classification", _CLASSES)),
        _rule("int_orders_enriched", "c_int_orders", "net_revenue_usd <= captured_usd"), _rule("int_orders_enriched", "c_int_orders", "refund_usd >= 0"),
        _rule("mart_revenue", "c_int_orders", "order_amount_usd >= 0"),
        _rule("mart_monthly_revenue", "c_mart_months", "gross_bookings_usd >= net_revenue_usd"),
        _rule("mart_monthly_revenue", "c_mart_months", "captured_cash_usd >= 0"),
        _tie("mart_revenue", "sum(captured_usd)", "c_int_orders", "stg_payments", "sum(if(is_primary_record and payment_status = 'succeeded', amount_usd, 0))", "c_stg_payments"),
    ),
    "dq_report_rides": _report(
        *_warn(*_keys("raw_riders", "r_raw_riders", "rider_id")), *_warn(*_keys("raw_trips", "r_raw_trips", "trip_id")), *_warn(*_keys("raw_payments", "r_raw_payments", "payment_id")),
        *_warn(*_keys("raw_driver_incentives", "r_raw_driver_incentives", "incentive_id")), *_warn(_null("raw_drivers", "r_raw_drivers", "driver_id")),
        *_warn(*_keys("stg_riders", "r_stg_riders", "rider_id")), *_warn(*_keys("stg_drivers", "r_stg_drivers", "driver_id")), *_warn(*_keys("stg_trips", "r_stg_trips", "trip_id")),
        *_warn(*_keys("stg_payments", "r_stg_payments", "payment_id")), *_warn(*_keys("stg_driver_incentives", "r_stg_incentives", "incentive_id")),
        *_warn(_null("stg_trips", "r_stg_trips", "trip_classification")), *_warn(_accepted("stg_trips", "r_stg_trips", "trip_classification", _TRIP_CLASSES)),
        *_warn(_null("stg_trips", "r_stg_trips", "rider_id")), *_warn(_null("stg_trips", "r_stg_trips", "driver_id")), *_warn(_null("stg_payments", "r_stg_payments", "trip_id")),
        *_warn(_null("stg_driver_incentives", "r_stg_incentives", "trip_id")), *_warn(_null("stg_driver_incentives", "r_stg_incentives", "driver_id")),
        *_warn(_child("stg_trips", "r_stg_trips", "rider_id", "stg_riders", "r_stg_riders")), *_warn(_child("stg_trips", "r_stg_trips", "driver_id", "stg_drivers", "r_stg_drivers")),
        *_warn(_child("stg_payments", "r_stg_payments", "trip_id", "stg_trips", "r_stg_trips")),
        *_warn(_child("stg_driver_incentives", "r_stg_incentives", "trip_id", "stg_trips", "r_stg_trips")),
        *_warn(_child("stg_driver_incentives", "r_stg_incentives", "driver_id", "stg_drivers", "r_stg_drivers")),
        *_warn(*_keys("mart_driver_performance", "r_mart_drivers", "driver_id")), *_warn(*_keys("mart_rider_activity", "r_mart_riders", "rider_id")),
        _rule("mart_driver_performance", "r_mart_drivers", "completion_rate_pct between 0 and 100"),
        _rule("mart_driver_performance", "r_mart_drivers", "total_incentive_paid_usd >= 0"),
        _rule("mart_rider_activity", "r_mart_riders", "completed_trips <= total_trips_requested"),
        _rule("mart_rider_activity", "r_mart_riders", "clean_completed_trips <= completed_trips"),
        _rule("mart_marketplace_kpis", "r_mart_months", "gmv_usd >= net_revenue_usd"),
        _rule("mart_marketplace_kpis", "r_mart_months", "fraud_rate_pct between 0 and 100"),
        _rule("mart_marketplace_kpis", "r_mart_months", "round(gmv_usd - net_revenue_usd, 2) = round(gmv_to_net_gap_usd, 2)"),
        _tie("mart_driver_performance", "sum(total_incentive_paid_usd)", "r_mart_drivers", "raw_driver_incentives", "sum(bonus_amount * if(currency = 'GBP', 1.27, 1.0))", "r_raw_driver_incentives"),
    ),
    "dq_report_telecom": _report(
        *_warn(*_keys("stg_subscribers", "t_stg_subscribers", "subscriber_id")), *_warn(*_keys("stg_plans", "t_raw_plans", "plan_code")), *_warn(*_keys("stg_usage", "t_stg_usage", "usage_id")),
        *_warn(*_keys("stg_payments", "t_stg_payments", "payment_id")), *_warn(*_keys("stg_support_tickets", "t_stg_tickets", "ticket_id")),
        *_warn(*_keys("int_subscriber_signals", "t_signals", "subscriber_id")), *_warn(*_keys("mart_subscriber_churn", "t_churn", "subscriber_id")),
        *_warn(_accepted("mart_subscriber_churn", "t_churn", "churn_type", _CHURN_TYPES)),
        _rule("mart_subscriber_churn", "t_churn", "usage_events_30d >= 0"), _rule("mart_subscriber_churn", "t_churn", "past_due_periods >= 0"),
        _rule("mart_churn_summary", f"({_T_SUMMARY})", "churned_any >= churned_all_three"),
        _rule("mart_churn_summary", f"({_T_SUMMARY})", "total_subscribers = 10000"),
    ),
    "dq_report_learning": _report(
        *_warn(*_keys("stg_courses", "l_raw_courses", "course_id")), *_warn(*_keys("stg_students", "l_raw_students", "enrollment_id")),
        *_warn(*_keys("stg_lessons", "l_stg_lessons", "lesson_event_id")), *_warn(*_keys("stg_assessments", "l_stg_assessments", "assessment_attempt_id")),
        *_warn(*_keys("int_enrollment_progress", "l_progress", "enrollment_id")), *_warn(*_keys("mart_enrollment_completion", "l_completion", "enrollment_id")),
        *_warn(_accepted("mart_enrollment_completion", "l_completion", "completion_category", _CATEGORIES)),
        _rule("mart_enrollment_completion", "l_completion", "lessons_completed <= lesson_count", "warn"),
        _rule("mart_enrollment_completion", "l_completion", "pct_lessons_completed >= 0"),
        _rule("mart_completion_summary", "l_summary", "complete_all_lessons <= complete_80pct_lessons"),
        _rule("mart_completion_summary", "l_summary", "total_people <= total_enrollments"),
    ),
    "profile_table": " UNION ALL ".join([
        _profile_id("payment_id"), _profile_id("order_id"), _profile_money("amount"), _profile_money("gateway_fee"),
        *[_profile(c) for c in ("payment_status", "currency", "payment_method", "attempted_at", "processed_at")],
    ]),
    "profile_merged": " UNION ALL ".join([
        *[_sketched(c, True) for c in ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")], _sketched("l_returnflag", False),
    ]),
    "value_counts": f"""
        SELECT event_type AS value, n, {ratio('n', 'total')} AS share_pct
        FROM (SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS total FROM events GROUP BY event_type)""",
    "dup_keys": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    # ---- metrics
    "refund_rate": f"""
        SELECT report_month, CAST(refunds_usd AS DOUBLE) AS refunds_usd, CAST(captured_cash_usd AS DOUBLE) AS captured_cash_usd,
               {money_ratio('refunds_usd', 'captured_cash_usd')} AS refund_rate_pct
        FROM c_mart_months""",
    "recognized_revenue": """
        SELECT make_timestamp(year(created_at), month(created_at), 1, 0, 0, 0) AS report_month, count(*) AS recognized_orders,
               CAST(sum(net_revenue_usd) AS DOUBLE) AS recognized_revenue_usd
        FROM c_int_orders WHERE revenue_classification = 'recognized' GROUP BY ALL""",
    "cancellation_rate": f"""
        SELECT report_month, cancelled_trips, total_trips, {ratio('cancelled_trips', 'total_trips')} AS cancellation_rate_pct FROM r_mart_months""",
    "cross_month_refunds": """
        SELECT CAST(date_trunc('month', o.created_at) AS TIMESTAMP) AS order_month, count(*) AS cross_month_refunds,
               CAST(sum(refund_amount_usd) AS DOUBLE) AS cross_month_refunds_usd
        FROM c_stg_refunds r JOIN c_raw_orders o ON o.order_id = r.order_id
        WHERE date_diff('month', o.created_at, r.processed_at) > 0 GROUP BY ALL""",
    "churn_split": f"""
        SELECT churn_type, n_lines, reactivated, {ratio('reactivated', 'n_lines')} AS reactivation_rate_pct
        FROM (SELECT churn_type, count(*) AS n_lines, count(*) FILTER (WHERE is_likely_reactivated) AS reactivated
              FROM t_churn WHERE account_status = 'cancelled' GROUP BY churn_type)""",
    "person_completion": f"""
        SELECT *, {ratio('people_platform', 'total_people', 1)} AS rate_platform, {ratio('people_all_lessons', 'total_people', 1)} AS rate_all_lessons,
               {ratio('people_80pct_lessons', 'total_people', 1)} AS rate_80pct_lessons, {ratio('people_assessment', 'total_people', 1)} AS rate_assessment
        FROM (SELECT count(DISTINCT student_id) AS total_people, count(DISTINCT student_id) FILTER (WHERE is_complete_platform) AS people_platform,
                     count(DISTINCT student_id) FILTER (WHERE is_complete_all_lessons) AS people_all_lessons,
                     count(DISTINCT student_id) FILTER (WHERE is_complete_80pct_lessons) AS people_80pct_lessons,
                     count(DISTINCT student_id) FILTER (WHERE is_complete_assessment) AS people_assessment
              FROM l_completion)""",
    "active_learners": """
        SELECT count(*) AS enrollments, count(*) FILTER (WHERE age <= to_days(28)) AS active_28d, count(*) FILTER (WHERE age <= to_days(7)) AS active_7d,
               count(DISTINCT student_id) AS people, count(DISTINCT student_id) FILTER (WHERE age <= to_days(28)) AS people_active_28d,
               count(DISTINCT student_id) FILTER (WHERE age <= to_days(7)) AS people_active_7d
        FROM (SELECT student_id, (SELECT max(last_active_at) FROM l_raw_students) - last_active_at AS age FROM l_raw_students)""",
    "learning_engagement": """
        SELECT category, enrollments, with_lessons,
               CAST((2 * lessons * 100 + enrollments) // (2 * enrollments) AS DOUBLE) / 100 AS avg_lessons_completed,
               CASE WHEN with_lessons > 0 THEN sign(days) * CAST((2 * abs(days) * 100 + with_lessons) // (2 * with_lessons) AS DOUBLE) / 100 END AS avg_days_to_complete
        FROM (SELECT category, count(*) AS enrollments, count(last_lesson_at) AS with_lessons, sum(lessons_completed) AS lessons,
                     sum(CAST(last_lesson_at AS DATE) - CAST(enrolled_at AS DATE)) AS days
              FROM l_progress GROUP BY category)""",
    "pass_rate": f"""
        SELECT graded_attempts, passed_attempts, {ratio('passed_attempts', 'graded_attempts', 1)} AS pass_rate_pct
        FROM (SELECT count(*) AS graded_attempts, count(*) FILTER (WHERE is_passed) AS passed_attempts FROM l_raw_assessments WHERE score IS NOT NULL)""",
    "trip_distance": f"""
        SELECT product, CAST(surge_multiplier AS DOUBLE) AS surge_multiplier, count(*) AS n_trips, CAST(sum(metres) AS BIGINT) AS total_metres,
               CAST(sum(fare) AS DOUBLE) AS fare_usd, round(CAST(sum(fare) AS DOUBLE) * 1000 / sum(metres), 2) AS revenue_per_km
        FROM (SELECT product, surge_multiplier, {gbp('gross_fare')} AS fare,
                     CAST(round(12742000.0 * asin(sqrt(pow(sin(radians(CAST(dropoff_lat - pickup_lat AS DOUBLE)) / 2), 2)
                       + cos(radians(CAST(pickup_lat AS DOUBLE))) * cos(radians(CAST(dropoff_lat AS DOUBLE)))
                         * pow(sin(radians(CAST(dropoff_lon - pickup_lon AS DOUBLE)) / 2), 2)))) AS BIGINT) AS metres
              FROM r_raw_trips WHERE trip_status = 'completed')
        GROUP BY product, surge_multiplier""",
    "incentive_exposure": f"""
        SELECT CAST(sum(paid) AS DOUBLE) AS total_usd, CAST(sum(paid) FILTER (WHERE NOT is_fraud_trip) AS DOUBLE) AS clean_usd,
               CAST(sum(paid) FILTER (WHERE is_fraud_trip) AS DOUBLE) AS fraud_usd, CAST(sum(paid) FILTER (WHERE is_multi_campaign) AS DOUBLE) AS multi_campaign_usd,
               count(*) FILTER (WHERE is_fraud_trip) AS fraud_lines
        FROM (SELECT *, {gbp('bonus_amount')} AS paid FROM r_stg_incentives)""",
    "uncaptured_trips": """
        SELECT trip_id, trip_status, CAST(gross_fare AS DOUBLE) AS gross_fare, currency FROM r_raw_trips
        WHERE gross_fare > 0 AND trip_id NOT IN (SELECT trip_id FROM r_raw_payments WHERE payment_status = 'captured')""",
    "status_contradictions": """
        SELECT order_status, ship_status, count(*) AS n_orders, CAST(sum(captured_usd) AS DOUBLE) AS captured_usd FROM c_int_orders
        WHERE order_status NOT IN ('completed', 'confirmed') AND ship_status IS NOT NULL GROUP BY ALL""",
    "fx_asof": """
        SELECT order_id, o.currency, CAST(order_amount AS DOUBLE) AS order_amount, created_at, rate_date AS quoted_on,
               CAST(if(o.currency = 'USD', 1.0, rate) AS DOUBLE) AS fx_rate_to_usd,
               CAST(order_amount * if(o.currency = 'USD', 1.0, rate) AS DOUBLE) AS order_amount_usd
        FROM c_raw_orders o ASOF LEFT JOIN x_quotes q ON o.currency = q.currency AND CAST(o.created_at AS DATE) >= q.rate_date""",
    "ops_findings": """
        SELECT (SELECT count(*) FROM c_raw_refunds) AS all_refunds,
               (SELECT count(*) FROM c_raw_refunds r JOIN c_raw_orders o USING (order_id) WHERE r.refund_amount < o.order_amount) AS partial_refunds,
               (SELECT count(*) FROM c_raw_refunds WHERE order_id NOT IN (SELECT order_id FROM c_raw_orders)) AS refunds_of_unknown_orders,
               (SELECT count(*) FROM c_cash WHERE had_duplicate_charge) AS duplicate_charge_orders""",
    "payout_findings": """
        SELECT campaign, count(*) AS n_lines, CAST(sum(payout_lag_days) AS BIGINT) AS lag_days_sum, min(payout_lag_days) AS min_lag_days,
               max(payout_lag_days) AS max_lag_days,
               CAST((2 * sum(payout_lag_days) * 100 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_lag_days
        FROM r_stg_incentives GROUP BY campaign""",
    "ticket_backlog": """
        SELECT category, count(*) AS tickets, count(*) FILTER (WHERE is_unresolved) AS unresolved_tickets FROM t_stg_tickets GROUP BY category""",
    # ---- streams: all arrivals in one batch, so every key survives once; an end mark closes every day
    "stream_replay_dedup": """
        SELECT DISTINCT subscriber_id // 10 AS subscriber_id, usage_type, CAST(usage_units AS DOUBLE) AS usage_units, CAST(usage_date AS DATE) AS usage_day
        FROM t_raw_usage""",
    "stream_daily_usage": """
        SELECT usage_day, usage_type, count(*) AS events, CAST(sum(usage_units) AS DOUBLE) AS units
        FROM (SELECT *, CAST(date_trunc('day', usage_date) AS TIMESTAMP) AS usage_day FROM t_raw_usage)
        GROUP BY usage_day, usage_type""",
}


def statements() -> dict[str, str]:
    return {name: with_parts(PARTS, final) for name, final in {**FINAL, **HISTORY_FINAL}.items()}

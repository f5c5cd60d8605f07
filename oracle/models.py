"""The layered models as plain SQL over the feeds: ranks by ordered lists, filters on aggregates."""

from oracle.compose import gbp, money_ratio, ratio, usd

_SUCCESS = "payment_status = 'succeeded'"
_CAPTURE = "payment_status = 'captured'"


def _share(flag: str, total: str = "count(*)", digits: int = 1) -> str:
    return ratio(f"count(*) FILTER (WHERE {flag})", total, digits)


MODELS = {
    # ---- commerce
    "c_stg_orders": f"""
        SELECT *, {usd('order_amount')} AS order_amount_usd, coalesce(created_at > updated_at, false) AS has_invalid_timestamp
        FROM c_raw_orders""",
    "c_first_charge": f"""
        SELECT order_id, count(*) FILTER (WHERE {_SUCCESS}) AS succeeded_per_order,
               (list(payment_id ORDER BY processed_at NULLS LAST, payment_id) FILTER (WHERE {_SUCCESS}))[1] AS first_id
        FROM c_raw_payments GROUP BY order_id""",
    "c_stg_payments": f"""
        SELECT p.*, {usd('amount')} AS amount_usd, {usd('gateway_fee')} AS gateway_fee_usd, f.succeeded_per_order,
               f.succeeded_per_order >= 2 AS is_duplicate_charge,
               p.payment_status = 'failed' OR coalesce(p.payment_id = f.first_id, false) AS is_primary_record
        FROM c_raw_payments p JOIN c_first_charge f ON p.order_id = f.order_id""",
    "c_stg_refunds": f"""
        SELECT *, {usd('refund_amount')} AS refund_amount_usd,
               make_timestamp(year(processed_at), month(processed_at), 1, 0, 0, 0) AS refund_month
        FROM c_raw_refunds""",
    "c_stg_shipping": """
        SELECT *, shipped_at IS NULL AS missing_ship_date, delivered_at IS NULL AS missing_delivery_date FROM c_raw_shipping""",
    "c_cash": f"""
        SELECT order_id, coalesce(sum(amount_usd) FILTER (WHERE is_primary_record AND {_SUCCESS}), 0) AS captured_usd,
               coalesce(sum(gateway_fee_usd) FILTER (WHERE is_primary_record AND {_SUCCESS}), 0) AS gateway_fee_usd,
               any_value(succeeded_per_order) AS succeeded_per_order, bool_or(is_duplicate_charge) AS had_duplicate_charge,
               max(processed_at) FILTER (WHERE {_SUCCESS}) AS paid_at
        FROM c_stg_payments GROUP BY order_id""",
    "c_back": """
        SELECT order_id, sum(refund_amount_usd) AS refund_usd, count(*) AS refund_count, max(processed_at) AS last_refund_at
        FROM c_stg_refunds GROUP BY order_id""",
    "c_parcels": """
        SELECT order_id, max(status) AS ship_status, max(shipped_at) AS shipped_at, bool_or(missing_ship_date) AS missing_ship_date
        FROM c_stg_shipping GROUP BY order_id""",
    "c_joined": """
        SELECT o.*, coalesce(captured_usd, 0) AS cash, coalesce(gateway_fee_usd, 0) AS fees, paid_at,
               coalesce(had_duplicate_charge, false) AS had_duplicate_charge, coalesce(refund_usd, 0) AS refunded,
               coalesce(refund_count, 0) AS refund_count, last_refund_at, ship_status, shipped_at,
               coalesce(missing_ship_date, false) AS missing_ship_date
        FROM c_stg_orders o LEFT JOIN c_cash USING (order_id) LEFT JOIN c_back USING (order_id) LEFT JOIN c_parcels USING (order_id)""",
    "c_int_orders": """
        SELECT *, cash AS captured_usd, fees AS gateway_fee_usd, refunded AS refund_usd, cash > 0 AS is_paid,
               refunded > 0 AND refunded >= order_amount_usd AS is_fully_refunded,
               CASE WHEN cash > 0 AND order_status <> 'cancelled'
                    THEN if(refunded >= order_amount_usd, 'paid_fully_refunded', 'recognized')
                    WHEN cash > 0 THEN 'paid_but_cancelled'
                    ELSE if(order_status = 'cancelled', 'cancelled_unpaid', 'unpaid_open') END AS revenue_classification,
               if(cash > 0, cash - refunded, 0) AS net_revenue_usd
        FROM c_joined""",
    "c_months": """
        SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP) AS report_month, count(*) AS total_orders,
               sum(order_amount_usd) AS gross,
               coalesce(sum(order_amount_usd) FILTER (WHERE revenue_classification = 'cancelled_unpaid'), 0) AS cancelled_unpaid_usd,
               coalesce(sum(order_amount_usd) FILTER (WHERE revenue_classification = 'unpaid_open'), 0) AS unpaid_open_usd,
               coalesce(sum(captured_usd) FILTER (WHERE revenue_classification = 'paid_but_cancelled'), 0) AS paid_but_cancelled_usd,
               coalesce(sum(order_amount_usd) FILTER (WHERE had_duplicate_charge), 0) AS duplicate_charge_exposure_usd,
               sum(captured_usd) AS captured_cash_usd, sum(refund_usd) AS refunds_usd, sum(net_revenue_usd) AS net,
               sum(gateway_fee_usd) AS gateway_fees_usd
        FROM c_int_orders GROUP BY ALL""",
    "c_mart_months": f"""
        SELECT *, gross AS gross_bookings_usd, net AS net_revenue_usd, gross - net AS bookings_to_net_gap_usd,
               {money_ratio('gross - net', 'gross')} AS gap_pct
        FROM c_months""",
    # ---- rides
    "r_stg_riders": "SELECT *, referred_by IS NOT NULL AS is_referred FROM r_raw_riders",
    "r_stg_drivers": """
        SELECT *, onboarding_count > 1 AS is_reonboarded FROM (
            SELECT *, count(*) OVER same AS onboarding_count FROM r_raw_drivers WINDOW same AS (PARTITION BY driver_id)
            QUALIFY onboarded_at = max(onboarded_at) OVER same)""",
    "r_stg_trips": """
        SELECT *, CASE WHEN trip_status = 'completed' THEN if(is_fraud_flagged IS NULL, NULL, if(is_fraud_flagged, 'fraud_completed', 'clean_completed'))
                       WHEN gross_fare > 0 THEN 'billed_cancellation' ELSE 'zero_fare_cancellation' END AS trip_classification,
               if(trip_status = 'completed' AND is_fraud_flagged IS NOT DISTINCT FROM false, gross_fare, 0) AS clean_revenue_fare,
               if(trip_status = 'cancelled' AND gross_fare > 0, gross_fare, 0) AS cancellation_fee_amount
        FROM r_raw_trips""",
    "r_first_capture": f"""
        SELECT trip_id, count(*) FILTER (WHERE {_CAPTURE}) AS captures_per_trip,
               (list(payment_id ORDER BY captured_at NULLS LAST, payment_id) FILTER (WHERE {_CAPTURE}))[1] AS first_id
        FROM r_raw_payments GROUP BY trip_id""",
    "r_stg_payments": """
        SELECT p.*, f.captures_per_trip, f.captures_per_trip >= 2 AS is_duplicate_capture,
               p.payment_status = 'failed' OR coalesce(p.payment_id = f.first_id, false) AS is_primary_record
        FROM r_raw_payments p JOIN r_first_capture f ON p.trip_id = f.trip_id""",
    "r_stg_incentives": """
        SELECT i.*, date_diff('day', earned_at, paid_at) AS payout_lag_days, coalesce(t.is_fraud_flagged, false) AS is_fraud_trip,
               n AS campaign_lines_per_trip, n > 1 AS is_multi_campaign
        FROM r_raw_driver_incentives i
        JOIN (SELECT trip_id, count(*) AS n FROM r_raw_driver_incentives GROUP BY trip_id) c ON c.trip_id = i.trip_id
        LEFT JOIN r_raw_trips t ON t.trip_id = i.trip_id""",
    "r_cash": f"""
        SELECT trip_id, coalesce(sum(amount) FILTER (WHERE is_primary_record AND {_CAPTURE}), 0) AS captured_amount,
               coalesce(sum(processor_fee) FILTER (WHERE is_primary_record AND {_CAPTURE}), 0) AS processor_fee,
               max(payment_method) AS payment_method, max(captured_at) AS captured_at,
               any_value(captures_per_trip) AS captures_per_trip, bool_or(is_duplicate_capture) AS had_duplicate_capture
        FROM r_stg_payments GROUP BY trip_id""",
    "r_bonus": """
        SELECT trip_id, sum(bonus_amount) AS total_incentive_amount, count(*) AS incentive_line_count,
               bool_or(is_multi_campaign) AS is_multi_campaign
        FROM r_stg_incentives GROUP BY trip_id""",
    "r_int_trips": f"""
        SELECT t.*, p.* EXCLUDE (trip_id), b.* EXCLUDE (trip_id), {gbp('1.00')} AS fx_rate_to_usd,
               {gbp('gross_fare')} AS gross_fare_usd, {gbp('clean_revenue_fare')} AS clean_revenue_fare_usd,
               {gbp('cancellation_fee_amount')} AS cancellation_fee_usd, {gbp('captured_amount')} AS captured_amount_usd,
               {gbp('processor_fee')} AS processor_fee_usd, {gbp('total_incentive_amount')} AS total_incentive_usd
        FROM r_stg_trips t LEFT JOIN r_cash p ON p.trip_id = t.trip_id LEFT JOIN r_bonus b ON b.trip_id = t.trip_id""",
    "r_by_driver": """
        SELECT driver_id, count(*) AS total_trips, count(*) FILTER (WHERE trip_status = 'completed') AS completed_trips,
               count(*) FILTER (WHERE trip_status = 'cancelled') AS cancelled_trips, count(*) FILTER (WHERE is_fraud_flagged) AS fraud_trips,
               count(*) FILTER (WHERE trip_classification = 'clean_completed') AS clean_completed_trips,
               sum(gross_fare_usd) AS gross_fare_usd, sum(clean_revenue_fare_usd) AS clean_revenue_usd,
               sum(captured_amount_usd) AS total_captured_usd, sum(processor_fee_usd) AS total_processor_fees_usd,
               coalesce(sum(captured_amount_usd) FILTER (WHERE had_duplicate_capture), 0) AS duplicate_capture_exposure_usd,
               min(requested_at) AS first_trip_at, max(requested_at) AS last_trip_at
        FROM r_int_trips GROUP BY driver_id""",
    "r_payouts": f"""
        SELECT driver_id, sum(paid) AS total_incentive_paid_usd,
               coalesce(sum(paid) FILTER (WHERE is_fraud_trip), 0) AS fraud_trip_incentive_usd,
               coalesce(sum(paid) FILTER (WHERE is_multi_campaign), 0) AS multi_campaign_incentive_usd,
               count(*) AS total_incentive_lines, count(DISTINCT trip_id) AS trips_with_incentives
        FROM (SELECT *, {gbp('bonus_amount')} AS paid FROM r_stg_incentives) GROUP BY driver_id""",
    "r_mart_drivers": f"""
        SELECT d.*, coalesce(total_trips, 0) AS total_trips, coalesce(completed_trips, 0) AS completed_trips,
               coalesce(cancelled_trips, 0) AS cancelled_trips, coalesce(fraud_trips, 0) AS fraud_trips,
               coalesce(clean_completed_trips, 0) AS clean_completed_trips,
               coalesce({ratio('completed_trips', 'total_trips')}, 0) AS completion_rate_pct,
               coalesce({ratio('fraud_trips', 'completed_trips')}, 0) AS fraud_rate_pct,
               coalesce(gross_fare_usd, 0) AS gross_fare_usd, coalesce(clean_revenue_usd, 0) AS clean_revenue_usd,
               coalesce(total_captured_usd, 0) AS total_captured_usd, coalesce(total_processor_fees_usd, 0) AS total_processor_fees_usd,
               coalesce(duplicate_capture_exposure_usd, 0) AS duplicate_capture_exposure_usd,
               coalesce(total_incentive_paid_usd, 0) AS total_incentive_paid_usd,
               coalesce(fraud_trip_incentive_usd, 0) AS fraud_trip_incentive_usd,
               coalesce(multi_campaign_incentive_usd, 0) AS multi_campaign_incentive_usd,
               coalesce(total_incentive_lines, 0) AS total_incentive_lines, coalesce(trips_with_incentives, 0) AS trips_with_incentives,
               first_trip_at, last_trip_at
        FROM r_stg_drivers d LEFT JOIN r_by_driver USING (driver_id) LEFT JOIN r_payouts USING (driver_id)""",
    "r_by_rider": """
        SELECT rider_id, count(*) AS asked, count(*) FILTER (WHERE trip_status = 'completed') AS done,
               count(*) FILTER (WHERE trip_classification = 'clean_completed') AS clean,
               count(*) FILTER (WHERE trip_classification = 'fraud_completed') AS fraud,
               count(*) FILTER (WHERE trip_status = 'cancelled') AS off, sum(gross_fare_usd) AS gross,
               sum(clean_revenue_fare_usd) AS revenue, sum(captured_amount_usd) AS captured,
               min(requested_at) AS first_trip_at, max(requested_at) AS last_trip_at,
               max(requested_at) FILTER (WHERE trip_status = 'completed') AS last_completed_at,
               max(requested_at) FILTER (WHERE trip_classification = 'clean_completed') AS last_clean_completed_at
        FROM r_int_trips GROUP BY rider_id""",
    "r_mart_riders": """
        SELECT r.*, coalesce(asked, 0) AS total_trips_requested, coalesce(done, 0) AS completed_trips,
               coalesce(clean, 0) AS clean_completed_trips, coalesce(fraud, 0) AS fraud_completed_trips,
               coalesce(off, 0) AS cancelled_trips, coalesce(gross, 0) AS total_gross_fare_usd,
               coalesce(revenue, 0) AS total_clean_revenue_usd, coalesce(captured, 0) AS total_captured_usd,
               first_trip_at, last_trip_at, account_status = 'active' AS is_active_crm,
               coalesce(last_trip_at >= since, false) AS is_active_requested_30d,
               coalesce(last_completed_at >= since, false) AS is_active_completed_30d,
               coalesce(last_clean_completed_at >= since, false) AS is_active_clean_30d
        FROM r_stg_riders r LEFT JOIN r_by_rider USING (rider_id), (SELECT max(requested_at) - to_days(30) AS since FROM r_raw_trips)""",
    "r_months": """
        SELECT CAST(date_trunc('month', requested_at) AS TIMESTAMP) AS report_month, count(*) AS total_trips,
               count(*) FILTER (WHERE trip_status = 'completed') AS completed_trips,
               count(*) FILTER (WHERE trip_status = 'cancelled') AS cancelled_trips,
               count(*) FILTER (WHERE trip_classification = 'clean_completed') AS clean_completed_trips,
               count(*) FILTER (WHERE trip_classification = 'fraud_completed') AS fraud_completed_trips,
               count(*) FILTER (WHERE trip_classification = 'billed_cancellation') AS billed_cancellation_trips,
               count(*) FILTER (WHERE trip_classification = 'zero_fare_cancellation') AS zero_fare_cancellation_trips,
               sum(gross_fare_usd) AS gmv_usd,
               coalesce(sum(gross_fare_usd) FILTER (WHERE trip_classification = 'zero_fare_cancellation'), 0) AS zero_fare_cancel_usd,
               coalesce(sum(gross_fare_usd) FILTER (WHERE trip_classification = 'fraud_completed'), 0) AS fraud_fare_usd,
               sum(cancellation_fee_usd) AS cancellation_fee_revenue_usd, sum(clean_revenue_fare_usd) AS clean_trip_revenue_usd,
               sum(captured_amount_usd) AS total_captured_usd, sum(processor_fee_usd) AS total_processor_fees_usd,
               coalesce(sum(captured_amount_usd) FILTER (WHERE had_duplicate_capture), 0) AS duplicate_capture_exposure_usd,
               sum(total_incentive_usd) AS total_incentive_spend_usd,
               coalesce(sum(total_incentive_usd) FILTER (WHERE is_fraud_flagged), 0) AS fraud_incentive_spend_usd
        FROM r_int_trips GROUP BY ALL""",
    "r_mart_months": f"""
        SELECT *, gmv_usd - net_revenue_usd AS gmv_to_net_gap_usd, {ratio('completed_trips', 'total_trips')} AS completion_rate_pct,
               {ratio('fraud_completed_trips', 'completed_trips')} AS fraud_rate_pct,
               if(gmv_usd > 0, {money_ratio('net_revenue_usd', 'gmv_usd')}, 0) AS take_rate_pct,
               if(gmv_usd > 0, {money_ratio('gmv_usd - net_revenue_usd', 'gmv_usd')}, 0) AS gmv_to_net_gap_pct
        FROM (SELECT *, total_captured_usd - total_processor_fees_usd AS net_revenue_usd FROM r_months)""",
    # ---- telecom (observed on 2024-01-30 with a window of thirty days)
    "t_stg_subscribers": """
        SELECT *, count(*) OVER same > 1 AS is_sim_swapped FROM t_raw_subscribers WINDOW same AS (PARTITION BY subscriber_id)
        QUALIFY activated_at = max(activated_at) OVER same""",
    "t_stg_usage": """
        SELECT u.* FROM t_raw_usage u SEMI JOIN (
            SELECT min(usage_id) AS usage_id FROM t_raw_usage GROUP BY subscriber_id, CAST(usage_date AS DATE), usage_type, usage_units
        ) kept ON kept.usage_id = u.usage_id""",
    "t_stg_payments": """
        SELECT * FROM t_raw_payments QUALIFY row_number() OVER (
            PARTITION BY subscriber_id, billing_period
            ORDER BY list_position(['paid', 'past_due'], payment_status) NULLS LAST, coalesce(paid_at, due_at) DESC NULLS FIRST, payment_id DESC) = 1""",
    "t_stg_tickets": "SELECT *, resolved_at IS NULL AS is_unresolved FROM t_raw_support_tickets",
    "t_used": """
        SELECT subscriber_id, count(*) FILTER (WHERE recent) AS events, coalesce(sum(usage_units) FILTER (WHERE recent), 0) AS units,
               max(usage_date) AS last_usage_at, count(*) AS lifetime
        FROM (SELECT *, usage_date >= TIMESTAMP '2023-12-31' AND usage_date <= TIMESTAMP '2024-01-30' AS recent FROM t_stg_usage)
        GROUP BY subscriber_id""",
    "t_paid": """
        SELECT subscriber_id, count(*) FILTER (WHERE payment_status = 'past_due') AS past_due,
               count(*) FILTER (WHERE payment_status = 'failed') AS failed,
               max(due_at) FILTER (WHERE payment_status = 'past_due') AS last_past_due_at
        FROM t_raw_payments GROUP BY subscriber_id""",
    "t_asked": "SELECT subscriber_id, count(*) AS tickets, count(*) FILTER (WHERE is_unresolved) AS unresolved FROM t_stg_tickets GROUP BY subscriber_id",
    "t_signals": """
        SELECT s.*, coalesce(events, 0) AS usage_events_30d, coalesce(units, 0) AS usage_units_30d, last_usage_at,
               coalesce(lifetime, 0) AS lifetime_usage_events, coalesce(past_due, 0) AS past_due_periods,
               coalesce(failed, 0) AS failed_periods, last_past_due_at, coalesce(tickets, 0) AS ticket_count,
               coalesce(unresolved, 0) AS unresolved_tickets
        FROM t_stg_subscribers s LEFT JOIN t_used USING (subscriber_id) LEFT JOIN t_paid USING (subscriber_id)
        LEFT JOIN t_asked USING (subscriber_id)""",
    "t_churn": """
        SELECT *, account_status = 'cancelled' AS is_churned_explicit, past_due_periods > 0 AS is_churned_payment_lapse,
               usage_events_30d = 0 AS is_churned_no_usage,
               if(account_status = 'cancelled', coalesce(disconnect_reason, 'not_cancelled'), 'not_cancelled') AS churn_type,
               account_status = 'cancelled' AND usage_events_30d > 0 AS is_likely_reactivated
        FROM t_signals""",
    # ---- learning
    "l_first": """
        SELECT enrollment_id, lesson_number,
               list(lesson_event_id ORDER BY coalesce(completed_at, started_at) NULLS LAST, lesson_event_id)[1] AS first_id
        FROM l_raw_lessons GROUP BY ALL""",
    "l_stg_lessons": """
        SELECT e.*, e.lesson_status = 'completed' AND e.completed_at IS NULL AS missing_completed_at,
               e.lesson_status = 'started' OR e.lesson_event_id = f.first_id AS is_primary_completion
        FROM l_raw_lessons e JOIN l_first f USING (enrollment_id, lesson_number)""",
    "l_stg_assessments": "SELECT *, attempt_status = 'submitted' AS is_ungraded FROM l_raw_assessments",
    "l_studied": """
        SELECT enrollment_id, max(coalesce(completed_at, started_at)) AS last_lesson_at,
               count(DISTINCT lesson_number) FILTER (WHERE lesson_status = 'completed' AND is_primary_completion) AS lessons_completed
        FROM l_stg_lessons GROUP BY enrollment_id""",
    "l_outcomes": """
        SELECT enrollment_id, count(*) AS total_attempts, count(*) FILTER (WHERE is_ungraded) AS ungraded_attempts,
               coalesce(bool_or(is_passed), false) AS ever_passed, max(score) AS best_score, min(submitted_at) AS first_attempt_at,
               max(graded_at) AS last_graded_at
        FROM l_stg_assessments GROUP BY enrollment_id""",
    "l_progress": f"""
        SELECT *, {ratio('lessons_completed', 'lesson_count', 1)} AS pct_lessons_completed
        FROM (SELECT e.*, course_title, category, lesson_count, pass_threshold, coalesce(lessons_completed, 0) AS lessons_completed,
                     last_lesson_at, coalesce(total_attempts, 0) AS assessment_attempts,
                     coalesce(ungraded_attempts, 0) AS ungraded_attempts, coalesce(ever_passed, false) AS passed_assessment,
                     best_score, last_graded_at, total_attempts IS NOT NULL AS sat_assessment
              FROM l_raw_students e LEFT JOIN l_raw_courses USING (course_id) LEFT JOIN l_studied USING (enrollment_id)
              LEFT JOIN l_outcomes USING (enrollment_id))""",
    "l_completion": """
        SELECT *, enrollment_status = 'completed' AS is_complete_platform,
               coalesce(lesson_count <= lessons_completed, false) AS is_complete_all_lessons,
               coalesce(pct_lessons_completed >= 80, false) AS is_complete_80pct_lessons, passed_assessment AS is_complete_assessment,
               CASE WHEN sat_assessment THEN if(passed_assessment, 'passed_exam', 'sat_failed_exam')
                    ELSE coalesce(if(pct_lessons_completed IS NULL, NULL, if(pct_lessons_completed >= 80, 'finished_lessons_no_exam', 'incomplete')), 'other')
               END AS completion_category,
               coalesce(passed_assessment AND lesson_count > lessons_completed, false) AS is_tested_out
        FROM l_progress""",
    "l_summary": f"""
        SELECT count(*) AS total_enrollments, count(DISTINCT student_id) AS total_people,
               count(*) FILTER (WHERE is_complete_platform) AS complete_platform,
               count(*) FILTER (WHERE is_complete_all_lessons) AS complete_all_lessons,
               count(*) FILTER (WHERE is_complete_80pct_lessons) AS complete_80pct_lessons,
               count(*) FILTER (WHERE is_complete_assessment) AS complete_assessment,
               {_share('is_complete_platform')} AS platform_rate_pct, {_share('is_complete_all_lessons')} AS all_lessons_rate_pct,
               {_share('is_complete_80pct_lessons')} AS pct80_rate_pct, {_share('is_complete_assessment')} AS assessment_rate_pct,
               count(*) FILTER (WHERE completion_category = 'passed_exam') AS bridge_passed_exam,
               count(*) FILTER (WHERE completion_category = 'finished_lessons_no_exam') AS bridge_lessons_no_exam,
               count(*) FILTER (WHERE completion_category = 'sat_failed_exam') AS bridge_sat_failed,
               count(*) FILTER (WHERE completion_category = 'incomplete') AS bridge_incomplete,
               count(*) FILTER (WHERE is_tested_out) AS tested_out
        FROM l_completion""",
}

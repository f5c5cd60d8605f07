"""The raw feeds, shaped from the benchmark tables with plain SQL (branches and UNION ALL)."""

FEEDS = {
    # ---- commerce
    "c_raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               ['completed', 'completed', 'confirmed', 'placed', 'cancelled'][CAST(o_orderpriority[1] AS INTEGER)] AS order_status, o_orderstatus AS shelf,
               CAST(o_totalprice AS DECIMAL(12,2)) AS order_amount,
               ['USD','USD','USD','USD','USD','EUR','GBP'][1 + o_custkey % 7] AS currency,
               o_orderdate + to_minutes(o_orderkey % 1440) AS created_at,
               o_orderdate + to_minutes(o_orderkey % 1440)
                 + CASE WHEN o_orderkey % 499 = 0 THEN to_hours(-5) ELSE to_hours(30) END AS updated_at
        FROM orders""",
    "c_settling": """
        SELECT *, order_id AS k, order_status IN ('completed', 'confirmed') AS settled,
               CASE order_status WHEN 'cancelled' THEN shelf = 'F' WHEN 'placed' THEN shelf = 'P' ELSE true END AS paid
        FROM c_raw_orders""",
    "c_attempts": """
        SELECT k, 1 AS n, 'failed' AS payment_status, 10 AS mins FROM c_settling WHERE k % 11 = 3 OR k % 11 = 7
        UNION ALL SELECT k, 2, 'failed', 20 FROM c_settling WHERE k % 11 = 7
        UNION ALL SELECT k, 3, 'succeeded', 40 FROM c_settling WHERE paid
        UNION ALL SELECT k, 4, 'succeeded', 41 FROM c_settling WHERE settled AND k % 23 = 0""",
    "c_raw_payments": """
        SELECT a.k * 10 + a.n AS payment_id, a.k AS order_id, a.payment_status, o.order_amount AS amount, o.currency,
               'pay-' || a.k % 4 AS payment_method,
               CAST(o.order_amount * 0.0175 + 0.15 AS DECIMAL(12,2)) AS gateway_fee,
               o.created_at + to_minutes(a.mins) AS attempted_at,
               CASE WHEN a.payment_status = 'succeeded' THEN o.created_at + to_minutes(a.mins + 1) END AS processed_at
        FROM c_attempts a JOIN c_raw_orders o ON o.order_id = a.k""",
    "c_raw_refunds": """
        SELECT k AS refund_id, k AS order_id, k * 10 + 3 AS payment_id,
               CASE k % 3 WHEN 0 THEN CAST(order_amount * 0.5 AS DECIMAL(12,2)) ELSE order_amount END AS refund_amount,
               currency, 'reason-' || k % 5 AS refund_reason,
               'completed' AS refund_status,
               created_at + to_minutes(41) + to_days(CAST(k % 6 * 10 AS INTEGER)) AS requested_at,
               created_at + to_minutes(101) + to_days(CAST(k % 6 * 11 AS INTEGER)) AS processed_at
        FROM c_settling WHERE paid AND ((order_status = 'cancelled' AND k % 5 < 4) OR (order_status <> 'cancelled' AND k % 13 = 0))""",
    "c_raw_shipping": """
        SELECT k * 2 + n AS shipment_id, k AS order_id, 'carrier-' || k % 4 AS carrier,
               CAST(k % 7 + 4.99 AS DECIMAL(12,2)) AS shipping_cost,
               CASE WHEN n = 1 OR k % 8 = 0 THEN 'step-2' ELSE 'step-1' END AS status,
               CASE WHEN k % 7 <> 3 THEN created_at + to_days(2 + n) END AS shipped_at,
               CASE WHEN k % 5 <> 1 THEN created_at + to_days(6 + n) END AS delivered_at
        FROM c_settling, (VALUES (0), (1)) parcel(n)
        WHERE paid AND (order_status <> 'cancelled' OR k % 5 = 0) AND (n = 0 OR k % 37 = 0)""",
    # ---- rides
    "r_priced": """
        SELECT o_orderkey AS k, o_custkey AS c, o_orderdate + to_minutes(o_orderkey % 1440) AS asked,
               CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderkey % 6 = 0 AS off
        FROM orders""",
    "r_raw_trips": """
        SELECT k AS trip_id, c AS rider_id, k % 97 AS driver_id,
               'zone-' || c % 4 AS city,
               'tier-' || k % 4 AS product,
               if(off, 'cancelled', 'completed') AS trip_status,
               CASE WHEN off THEN 'cause-' || k % 5 END AS cancel_reason,
               CAST(CASE WHEN NOT off THEN price WHEN k % 5 = 2 OR k % 7 < 3 THEN 0
                    ELSE CAST(price * 0.25 AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS gross_fare,
               CAST(k % 5 * 0.25 + 1 AS DECIMAL(5,2)) AS surge_multiplier,
               if(c % 4 = 2, 'GBP', 'USD') AS currency,
               CASE WHEN k % 1009 = 0 THEN NULL ELSE NOT off AND k % 31 = 0 END AS is_fraud_flagged,
               CAST(k % 1000 * 0.0001 + 40 AS DECIMAL(9,6)) AS pickup_lat, CAST(c % 1000 * 0.0001 - 74 AS DECIMAL(9,6)) AS pickup_lon,
               CAST(k % 777 * 0.0002 + 40 AS DECIMAL(9,6)) AS dropoff_lat, CAST(c % 555 * 0.0002 - 74 AS DECIMAL(9,6)) AS dropoff_lon,
               asked AS requested_at, asked + to_minutes(if(k % 499 = 0, -2, 3)) AS accepted_at,
               CASE WHEN NOT off THEN asked + to_minutes(10) END AS started_at,
               CASE WHEN NOT off THEN asked + to_minutes(35) END AS ended_at
        FROM r_priced""",
    "r_raw_riders": """
        SELECT c_custkey AS rider_id, 'zone-' || c_custkey % 4 AS home_city,
               CASE WHEN c_custkey % 50 = 7 THEN 'account-0' WHEN c_mktsegment = 'MACHINERY' OR c_mktsegment = 'HOUSEHOLD' THEN lower(c_mktsegment) ELSE 'active' END AS account_status,
               TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 700 AS INTEGER)) AS signup_at,
               CASE WHEN c_custkey % 4 = 1 THEN c_custkey - 1 END AS referred_by
        FROM customer""",
    "r_raw_drivers": """
        SELECT s_suppkey AS driver_id, 'zone-' || s_suppkey % 4 AS home_city,
               CASE WHEN s_suppkey % 20 = 3 THEN 'state-2' WHEN s_suppkey % 13 = 5 THEN 'state-1' ELSE 'state-0' END AS driver_status,
               CAST(3.90 + s_suppkey % 111 * 0.01 AS DECIMAL(4,2)) AS rating,
               TIMESTAMP '1993-01-01' + to_days(CAST(s_suppkey % 400 + 500 * n AS INTEGER)) AS onboarded_at,
               'class-' || (s_suppkey + n) % 3 AS vehicle_class
        FROM supplier, (VALUES (0), (1)) again(n) WHERE n = 0 OR s_suppkey % 25 = 0""",
    "r_attempts": """
        SELECT trip_id AS k, 1 AS n, 'failed' AS payment_status, 40 AS mins FROM r_raw_trips WHERE trip_id % 11 IN (3, 7)
        UNION ALL SELECT trip_id, 2, 'failed', 45 FROM r_raw_trips WHERE trip_id % 11 = 7
        UNION ALL SELECT trip_id, 3, 'captured', 50 FROM r_raw_trips WHERE trip_id % 14 > 0
        UNION ALL SELECT trip_id, 4, 'captured', 51 FROM r_raw_trips WHERE trip_id % 14 > 0 AND trip_id % 29 = 0""",
    "r_raw_payments": """
        SELECT a.k * 10 + a.n AS payment_id, t.trip_id, t.rider_id, a.payment_status, t.gross_fare AS amount, t.currency,
               'pay-' || a.k % 4 AS payment_method,
               CAST(t.gross_fare * 0.0125 + 0.05 AS DECIMAL(12,2)) AS processor_fee,
               t.requested_at + to_minutes(a.mins) AS attempted_at,
               CASE WHEN a.payment_status = 'captured' AND t.trip_status = 'completed'
                    THEN t.requested_at + to_minutes(a.mins + 1) END AS captured_at
        FROM r_attempts a JOIN r_raw_trips t ON t.trip_id = a.k WHERE t.gross_fare > 0""",
    "r_raw_driver_incentives": """
        SELECT trip_id * 2 + n AS incentive_id, driver_id, trip_id,
               'campaign-' || (trip_id + n) % 5 AS campaign,
               CAST((trip_id % 9 + n) * 0.75 + 2.5 AS DECIMAL(12,2)) AS bonus_amount, currency, ended_at AS earned_at,
               ended_at + to_days(CAST(trip_id % 35 + 3 AS INTEGER)) + to_hours((trip_id + n) % 24) AS paid_at
        FROM r_raw_trips, (VALUES (0), (1)) line(n)
        WHERE trip_status = 'completed' AND trip_id % 3 = 0 AND (n = 0 OR trip_id % 11 = 0)""",
    # ---- telecom
    "t_raw_subscribers": """
        SELECT c_custkey AS subscriber_id, 'Brand#' || (c_custkey % 25 + 1) AS plan_code,
               'region-' || c_custkey % 5 AS region,
               if(gone, 'cancelled', 'active') AS account_status, c_custkey % 2 = 0 AS autopay_enrolled,
               CASE WHEN gone AND c_custkey % 49 <> 0 THEN ['voluntary','involuntary','ported_out'][1 + c_custkey % 3] END AS disconnect_reason,
               TIMESTAMP '2023-01-01' + to_days(CAST(c_custkey % 365 + 40 * n AS INTEGER)) AS activated_at,
               CASE WHEN gone THEN TIMESTAMP '2023-12-01' + to_days(CAST(c_custkey % 60 AS INTEGER)) END AS cancelled_at
        FROM (SELECT c_custkey, n, n = 0 AND c_custkey % 7 = 0 AS gone FROM customer, (VALUES (0), (1)) swap(n)
              WHERE n = 0 OR c_custkey % 50 = 0)""",
    "t_raw_plans": """
        SELECT p_brand AS plan_code, 'type-' || min(p_partkey) % 2 AS plan_type,
               CAST(min(p_retailprice) AS DECIMAL(12,2)) AS monthly_recurring_charge,
               max(p_size) AS data_allowance_gb, min(p_partkey) % 3 * 12 AS contract_months
        FROM part GROUP BY p_brand""",
    "t_raw_usage": """
        SELECT event_id AS usage_id, user_id * 10 AS subscriber_id, event_type AS usage_type,
               CAST(round(value / 10) AS DECIMAL(14,3)) AS usage_units, ts AS usage_date
        FROM events WHERE event_type <> 'error'""",
    "t_cycles": """
        SELECT c_custkey AS c, n, (c_custkey + n) % 9 = 0 AS failed,
               (n = 3 AND c_custkey % 11 = 0) OR (n = 2 AND c_custkey % 55 = 0) AS past_due,
               TIMESTAMP '2023-11-15' + to_days(CAST(30 * (n - 1) AS INTEGER)) AS due
        FROM customer, (VALUES (1), (2), (3)) cycle(n)""",
    "t_charges": """
        SELECT c, n, c * 10 + n AS payment_id, CASE WHEN past_due THEN 'past_due' WHEN failed THEN 'failed' ELSE 'paid' END AS status,
               due, CASE WHEN NOT past_due AND NOT failed THEN due + to_days(2) END AS paid_at FROM t_cycles
        UNION ALL
        SELECT c, n, c * 10 + n + 5, 'paid', due, due + to_days(5) FROM t_cycles WHERE failed AND c % 2 = 0""",
    "t_raw_payments": """
        SELECT payment_id, c AS subscriber_id, ['2023-11','2023-12','2024-01'][n] AS billing_period,
               CAST(20 + c % 30 AS DECIMAL(12,2)) AS amount_due, status AS payment_status,
               'pay-' || c % 4 AS payment_method, due AS due_at, paid_at
        FROM t_charges""",
    "t_raw_support_tickets": """
        SELECT event_id AS ticket_id, user_id * 10 AS subscriber_id,
               'topic-' || event_id % 6 AS category,
               'channel-' || event_id % 5 AS channel, ts AS opened_at,
               CASE WHEN event_id % 10 > 0 THEN ts + to_hours(event_id % 72) END AS resolved_at
        FROM events WHERE event_type = 'error'""",
    # ---- learning
    "l_raw_students": """
        SELECT o_orderkey AS enrollment_id, o_custkey AS student_id,
               if(o_orderkey % 997 = 0, -1, o_orderkey % 200) AS course_id,
               'plan-' || o_orderkey % 3 AS plan, 'locale-' || o_orderkey % 4 AS locale,
               if(o_orderkey % 5 = 0, 'completed', 'state-' || o_orderkey % 5) AS enrollment_status,
               o_orderdate AS enrolled_at,
               o_orderdate + to_days(CAST(if(o_orderkey % 499 = 0, -1, o_orderkey % 90) AS INTEGER)) AS last_active_at
        FROM orders""",
    "l_raw_courses": """
        SELECT p_partkey AS course_id, p_name AS course_title, 'field-' || p_partkey % 4 AS category,
               if(p_partkey % 50 = 7, 2, p_partkey % 4 + 7) AS lesson_count, 70 AS pass_threshold, p_partkey % 10 < 9 AS is_active,
               TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 365 AS INTEGER)) AS created_at
        FROM part""",
    "l_raw_lessons": """
        SELECT (l_orderkey * 8 + l_linenumber) * 4194304
                 + (l_partkey * 40503 + l_suppkey * 977 + dayofyear(l_shipdate) * 31) % 4194304 AS lesson_event_id,
               l_orderkey AS enrollment_id, l_orderkey AS student_id, l_orderkey % 200 AS course_id,
               l_linenumber AS lesson_number, 'kind-' || l_partkey % 4 AS lesson_type,
               if(l_partkey % 19 = 0, 'started', 'completed') AS lesson_status,
               'device-' || l_suppkey % 3 AS device, CAST(l_quantity AS INTEGER) AS duration_minutes,
               l_shipdate + to_minutes(l_partkey % 600) AS started_at,
               CASE WHEN l_partkey % 19 <> 0 AND l_partkey % 17 <> 0
                    THEN l_shipdate + to_minutes(l_partkey % 600 + CAST(l_quantity AS BIGINT)) END AS completed_at
        FROM lineitem""",
    "l_raw_assessments": """
        SELECT enrollment_id * 2 AS assessment_attempt_id, enrollment_id, student_id, course_id, 'kind-0' AS assessment_type,
               CASE WHEN enrollment_id % 41 > 0 THEN enrollment_id % 66 + 35 END AS score, 70 AS pass_threshold,
               CASE WHEN enrollment_id % 41 > 0 THEN enrollment_id % 66 >= 35 END AS is_passed,
               if(enrollment_id % 41 > 0, 'graded', 'submitted') AS attempt_status,
               enrolled_at + to_days(30) AS submitted_at,
               CASE WHEN enrollment_id % 41 > 0 THEN enrolled_at + to_days(31) END AS graded_at
        FROM l_raw_students WHERE enrollment_id % 3 = 0
        UNION ALL
        SELECT enrollment_id * 2 + 1, enrollment_id, student_id, course_id, 'kind-0', enrollment_id % 31 + 70, 70, true,
               'graded', enrolled_at + to_days(37), enrolled_at + to_days(38)
        FROM l_raw_students WHERE enrollment_id % 9 = 0""",
    # ---- exchange rates
    "x_quotes": """
        SELECT rate_date, currency, CAST(base + day(rate_date) * 0.001 AS DECIMAL(6,3)) AS rate
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders), (VALUES ('EUR', 1.05), ('GBP', 1.20)) m(currency, base)
        WHERE isodow(rate_date) < 6""",
}

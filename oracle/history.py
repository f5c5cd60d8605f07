"""Snapshots, restatements and line matches as plain SQL."""

from __future__ import annotations

import re

from oracle.compose import gbp
from oracle.feeds import FEEDS
from oracle.models import MODELS


def _again(prefix: str, changed: dict[str, str]) -> dict[str, str]:
    """The commerce parts once more under another prefix, over changed feeds."""
    out = {re.sub("^c_", prefix, name): re.sub(r"\bc_", prefix, sql) for name, sql in {**FEEDS, **MODELS}.items() if name.startswith("c_")}
    return {**out, **{f"{prefix}raw_{name}": sql for name, sql in changed.items()}}


_SAME = {name: f"SELECT * FROM c_raw_{name}" for name in ("payments", "refunds", "shipping")}
_DAYS = 2
_GAPS = [s * d for d in range(1, _DAYS + 1) for s in (-1, 1)]


def _assignment() -> dict[str, str]:
    """Days with lines to spare, gap by gap: state before each gap, and what it moves."""
    parts = {
        "lm_state_0": """
            SELECT key, amount, day, count(*) FILTER (WHERE side = 'left') AS l, count(*) FILTER (WHERE side = 'right') AS r,
                   least(count(*) FILTER (WHERE side = 'left'), count(*) FILTER (WHERE side = 'right')) AS ul,
                   least(count(*) FILTER (WHERE side = 'left'), count(*) FILTER (WHERE side = 'right')) AS ur
            FROM lm_lines GROUP BY key, amount, day""",
    }
    for i, gap in enumerate(_GAPS):
        parts[f"lm_move_{i}"] = f"""
            SELECT a.key, a.amount, a.day, b.day AS other, a.ul AS lf, b.ur AS rf, least(a.l - a.ul, b.r - b.ur) AS m
            FROM lm_state_{i} a JOIN lm_state_{i} b ON a.key = b.key AND a.amount = b.amount AND b.day = a.day + ({gap})
            WHERE a.l > a.ul AND b.r > b.ur"""
        parts[f"lm_state_{i + 1}"] = f"""
            SELECT s.key, s.amount, s.day, l, r, ul + coalesce(x.m, 0) AS ul, ur + coalesce(y.m, 0) AS ur
            FROM lm_state_{i} s LEFT JOIN lm_move_{i} x ON s.key = x.key AND s.amount = x.amount AND s.day = x.day
            LEFT JOIN lm_move_{i} y ON s.key = y.key AND s.amount = y.amount AND s.day = y.other"""
    moves = " UNION ALL ".join(f"SELECT * FROM lm_move_{i}" for i in range(len(_GAPS)))
    parts["lm_ranges"] = f"SELECT key, amount, day, day AS other, 0 AS lf, 0 AS rf, least(l, r) AS m FROM lm_state_0 WHERE least(l, r) > 0 UNION ALL {moves}"
    return parts


HISTORY_PARTS = {
    **_again("cb_", {
        **_SAME,
        "orders": """
            SELECT * REPLACE (if(order_id % 43 = 7, 'cancelled', order_status) AS order_status,
                              if(order_id % 53 = 9, created_at - INTERVAL 40 DAY, created_at) AS created_at)
            FROM c_raw_orders WHERE order_id % 29 <> 3""",
        "payments": "SELECT * REPLACE (if(order_id % 37 = 5, CAST(amount * 0.9 AS DECIMAL(12,2)), amount) AS amount) FROM c_raw_payments",
        "refunds": "SELECT * FROM c_raw_refunds WHERE processed_at < TIMESTAMP '2000-12-01'",
    }),
    **_again("ca_", {**_SAME, "orders": "SELECT * FROM c_raw_orders WHERE order_id % 41 <> 11"}),
    "rs_rows": """
        SELECT b.order_id AS bo, a.order_id AS ao, CAST(date_trunc('month', b.created_at) AS TIMESTAMP) AS bp, CAST(date_trunc('month', a.created_at) AS TIMESTAMP) AS ap,
               b.revenue_classification AS bc, a.revenue_classification AS ac, b.net_revenue_usd AS bm,
               if(b.revenue_classification = 'recognized', b.net_revenue_usd, 0) AS kb, if(a.revenue_classification = 'recognized', a.net_revenue_usd, 0) AS ka
        FROM cb_int_orders b FULL JOIN ca_int_orders a ON a.order_id = b.order_id""",
    "rs_lines": """
        SELECT ap AS period, if(ap <= TIMESTAMP '2000-11-01', 'late', 'new') AS cause, ka AS v FROM rs_rows WHERE bo IS NULL
        UNION ALL SELECT bp, 'withdrawn', -kb FROM rs_rows WHERE ao IS NULL
        UNION ALL SELECT unnest([bp, ap]), 'moved', unnest([-kb, kb]) FROM rs_rows WHERE ao = bo AND ap <> bp
        UNION ALL SELECT ap, 'reclassified', if(ac = 'recognized', bm, 0) - kb FROM rs_rows WHERE ao = bo AND ac <> bc
        UNION ALL SELECT ap, 'corrected', ka - if(ac = 'recognized', bm, 0) FROM rs_rows WHERE ao = bo
        UNION ALL SELECT ap, 'after', ka FROM rs_rows WHERE ao IS NOT NULL
        UNION ALL SELECT bp, 'before', kb FROM rs_rows WHERE bo IS NOT NULL""",
    # ---- snapshots
    "sn_taken": "SELECT * FROM (VALUES (0, TIMESTAMP '1996-07-01'), (1, TIMESTAMP '1998-07-01'), (2, TIMESTAMP '2001-09-01')) t(i, taken)",
    "sn_trips": """
        SELECT trip_id, trip_status, i, is_fraud_flagged AND CAST(requested_at AS DATE) + CAST(trip_id % 900 AS INTEGER) <= CAST(taken AS DATE)
                   AND NOT (i = 2 AND trip_id % 217 = 0) AS is_fraud_flagged
        FROM r_raw_trips, sn_taken WHERE requested_at < taken""",
    "sn_runs": """
        SELECT trip_id, trip_status, is_fraud_flagged, min(i) AS a, max(i) AS b
        FROM (SELECT *, i - row_number() OVER (PARTITION BY trip_id, trip_status, is_fraud_flagged ORDER BY i) AS island FROM sn_trips)
        GROUP BY trip_id, trip_status, is_fraud_flagged, island""",
    "sn_events": """
        SELECT trip_id, taken, unset FROM (SELECT trip_id, a AS i, false AS unset FROM sn_runs WHERE is_fraud_flagged
            UNION ALL SELECT trip_id, b + 1, true FROM sn_runs WHERE is_fraud_flagged) e JOIN sn_taken USING (i)""",
    "sn_booked": f"""
        SELECT CAST(date_trunc('month', taken) AS TIMESTAMP) AS report_month, count(*) FILTER (WHERE NOT unset) AS flags_set, count(*) FILTER (WHERE unset) AS flags_cleared,
               sum(if(unset, -1, 1) * {gbp('gross_fare')}) AS reversed
        FROM sn_events JOIN r_raw_trips USING (trip_id) GROUP BY ALL""",
    "sn_months": """
        SELECT CAST(date_trunc('month', requested_at) AS TIMESTAMP) AS report_month, sum(gross_fare_usd) AS gmv, sum(captured_amount_usd) - sum(processor_fee_usd) AS net
        FROM r_int_trips GROUP BY ALL""",
    "sn_both": """
        SELECT report_month, coalesce(gmv, 0) AS gmv, coalesce(net, 0) AS net, coalesce(flags_set, 0) AS flags_set, coalesce(flags_cleared, 0) AS flags_cleared, coalesce(reversed, 0) AS reversed
        FROM sn_months FULL JOIN sn_booked USING (report_month)""",
    # ---- rates on two axes
    "fx_every": """
        SELECT rate_date, currency, rate, rate_date + 1 AS known_on FROM x_quotes
        UNION ALL SELECT rate_date, currency, CAST(rate + 0.010 AS DECIMAL(6,3)), rate_date + 45 FROM x_quotes WHERE day(rate_date) % 5 = 0""",
    "fx_known": """
        SELECT as_of, currency, rate_date, arg_max(rate, {'k': known_on, 'r': rate}) AS rate
        FROM fx_every, (VALUES (DATE '1998-06-30'), (DATE '2002-01-01')) a(as_of) WHERE known_on <= as_of GROUP BY as_of, currency, rate_date""",
    "fx_priced": """
        SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP) AS report_month, o.as_of, order_amount * if(o.currency = 'USD', 1.0, rate) AS usd
        FROM (SELECT * FROM c_raw_orders, (VALUES (DATE '1998-06-30'), (DATE '2002-01-01')) a(as_of) WHERE created_at < TIMESTAMP '1998-07-01') o
        ASOF LEFT JOIN fx_known q ON o.currency = q.currency AND o.as_of = q.as_of AND CAST(o.created_at AS DATE) >= q.rate_date""",
    # ---- line match
    "lm_paid": """
        SELECT payment_id, payment_method AS key, CAST(ceil(amount / 50000) * 50000 AS DECIMAL(12,2)) AS amount, CAST(processed_at AS DATE) AS day
        FROM c_raw_payments WHERE payment_status = 'succeeded'""",
    "lm_raw": """
        SELECT 'left' AS side, payment_id AS line_id, key, amount, day FROM lm_paid
        UNION ALL
        SELECT 'right', payment_id * 3 + n, key, CAST(amount - if(payment_id % 59 = 4, 1, 0) AS DECIMAL(12,2)),
               day + CASE payment_id % 10 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN -1 WHEN 3 THEN 9 ELSE 0 END
        FROM lm_paid, (VALUES (0), (1)) twice(n) WHERE payment_id % 53 <> 3 AND (n = 0 OR payment_id % 61 = 8)""",
    "lm_lines": "SELECT *, row_number() OVER (PARTITION BY side, key, amount, day ORDER BY substr(md5(CAST(line_id AS VARCHAR)), 1, 2), line_id) - 1 AS place FROM lm_raw",
    **_assignment(),
    "lm_pairs": """
        SELECT l.line_id AS left_id, r.line_id AS right_id, g.other - g.day AS day_gap
        FROM lm_lines l JOIN lm_ranges g ON l.key = g.key AND l.amount = g.amount AND l.day = g.day AND l.place >= g.lf AND l.place < g.lf + g.m
        JOIN lm_lines r ON r.side = 'right' AND r.key = g.key AND r.amount = g.amount AND r.day = g.other AND r.place = l.place - g.lf + g.rf
        WHERE l.side = 'left'""",
    "lm_all": """
        SELECT n.*, coalesce(p.right_id, q.left_id) AS matched_id, coalesce(p.day_gap, q.day_gap) AS day_gap
        FROM lm_lines n LEFT JOIN lm_pairs p ON n.side = 'left' AND p.left_id = n.line_id LEFT JOIN lm_pairs q ON n.side = 'right' AND q.right_id = n.line_id""",
    "lm_spare": "SELECT DISTINCT side, key, amount, day FROM lm_all WHERE matched_id IS NULL",
    "lm_final": f"""
        SELECT side, line_id, key, amount, day, matched_id, day_gap,
               CASE WHEN matched_id IS NOT NULL THEN if(day_gap = 0, 'same_day', 'near_day')
                    WHEN EXISTS (SELECT 1 FROM lm_spare s WHERE s.side <> n.side AND s.key = n.key AND s.day BETWEEN n.day - {_DAYS} AND n.day + {_DAYS}) THEN 'other_amount'
                    WHEN EXISTS (SELECT 1 FROM lm_spare s WHERE s.side <> n.side AND s.key = n.key AND s.amount = n.amount) THEN 'other_day' ELSE 'missing' END AS match_class
        FROM lm_all n""",
}

_CAUSES = ["late", "new", "corrected", "reclassified", "moved", "withdrawn"]


def _total(cause: str) -> str:
    return f"coalesce(sum(v) FILTER (WHERE cause = '{cause}'), 0)"


HISTORY_FINAL = {
    "flag_validity": """
        SELECT trip_id, trip_status, is_fraud_flagged, f.taken AS valid_from, t.taken AS valid_to
        FROM sn_runs JOIN sn_taken f ON f.i = a LEFT JOIN sn_taken t ON t.i = b + 1""",
    "fraud_reversals": """
        SELECT report_month, CAST(gmv AS DOUBLE) AS gmv_usd, CAST(net AS DOUBLE) AS net_revenue_usd, flags_set, flags_cleared, CAST(reversed AS DOUBLE) AS fraud_reversal_usd,
               CAST(net - reversed AS DOUBLE) AS net_after_reversals_usd, CAST(gmv - (net - reversed) AS DOUBLE) AS gmv_to_net_gap_usd, gmv - (net - reversed) = gmv - net + reversed AS ties
        FROM sn_both""",
    "restatement_bridge": f"""
        SELECT period, {', '.join(f"CAST({_total(c)} AS DOUBLE) AS {c}" for c in ['before', *_CAUSES, 'after'])},
               {', '.join(f"count(*) FILTER (WHERE cause = '{c}' AND v <> 0) AS n_{c}" for c in _CAUSES)},
               CAST({_total('after')} - {_total('before')} AS DOUBLE) AS change, {_total('after')} - {_total('before')} = {' + '.join(map(_total, _CAUSES))} AS ties
        FROM rs_lines GROUP BY period""",
    "ledger_match_lines": "SELECT side, line_id, key, CAST(amount AS DOUBLE) AS amount, day, matched_id, day_gap, match_class FROM lm_final",
    "ledger_match": "SELECT side, match_class, count(*) AS n_lines, CAST(sum(amount) AS DOUBLE) AS amount FROM lm_final GROUP BY ALL",
    "trailing_active_riders": """
        SELECT day, count(DISTINCT rider_id) FILTER (WHERE on_day = day) AS active_1d, count(DISTINCT rider_id) FILTER (WHERE on_day > day - 7) AS active_7d, count(DISTINCT rider_id) AS active_28d
        FROM (SELECT unnest(range(min(requested_at)::DATE, max(requested_at)::DATE + 1, INTERVAL 1 DAY))::DATE AS day FROM r_raw_trips WHERE trip_status = 'completed') d
        LEFT JOIN (SELECT DISTINCT rider_id, CAST(requested_at AS DATE) AS on_day FROM r_raw_trips WHERE trip_status = 'completed') a ON on_day > day - 28 AND on_day <= day
        GROUP BY day""",
    "robust_gap_trend": """
        SELECT report_month, gap_pct, round(base, 6) AS baseline, n_past, spread, if(spread > 0, round((gap_pct - base) / spread, 4), NULL) AS score,
               coalesce(n_past >= 6 AND if(spread > 0, abs(gap_pct - base) > 3.0 * spread, abs(gap_pct - base) > 0), false) AS is_anomaly
        FROM (SELECT *, round((apart[(n_past - 1) // 2 + 1] + apart[n_past // 2 + 1]) / 2 * 1.4826::DOUBLE, 6) AS spread FROM (
            SELECT *, list_sort([abs(x - base) FOR x IN past]) AS apart FROM (
                SELECT *, len(past) AS n_past, (past[(len(past) - 1) // 2 + 1] + past[len(past) // 2 + 1]) / 2 AS base FROM (
                    SELECT report_month, gap_pct, coalesce(list_sort(list(gap_pct) OVER (ORDER BY report_month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)), []) AS past FROM c_mart_months))))""",
    "fx_restated": """
        SELECT report_month, CAST(sum(usd) FILTER (WHERE as_of < DATE '2000-01-01') AS DOUBLE) AS at_close_usd, CAST(sum(usd) FILTER (WHERE as_of > DATE '2000-01-01') AS DOUBLE) AS as_known_later_usd,
               CAST(sum(usd) FILTER (WHERE as_of > DATE '2000-01-01') - sum(usd) FILTER (WHERE as_of < DATE '2000-01-01') AS DOUBLE) AS change_usd
        FROM fx_priced GROUP BY report_month""",
    "stream_first_rows": """
        SELECT min(usage_id) AS usage_id, subscriber_id, usage_type, CAST(usage_units AS DOUBLE) AS usage_units, CAST(usage_date AS DATE) AS usage_day
        FROM t_raw_usage GROUP BY subscriber_id, usage_type, usage_units, CAST(usage_date AS DATE)""",
    "stream_arrival_counts": """
        SELECT count(*) AS n_input, count(DISTINCT (subscriber_id, usage_type, usage_units, CAST(usage_date AS DATE))) AS n_kept,
               count(*) - count(DISTINCT (subscriber_id, usage_type, usage_units, CAST(usage_date AS DATE))) AS n_replay, true AS balances
        FROM t_raw_usage""",
    "stream_uncaptured": """
        SELECT trip_id, trip_status, CAST(gross_fare AS DOUBLE) AS gross_fare, currency FROM r_raw_trips t
        WHERE gross_fare > 0 AND NOT EXISTS (SELECT 1 FROM r_raw_payments p WHERE p.trip_id = t.trip_id AND p.payment_status = 'captured'
            AND p.attempted_at BETWEEN t.requested_at AND t.requested_at + INTERVAL 2 DAY)""",
}

"""Shape the benchmark tables (orders, lineitem, events, ...) into the raw feeds.

The domains run on any DataFrames in the declared schemas; this is one supplier of them.
All dirt is placed by integer modulo, so the feeds are the same on every run and engine.
Rows that multiply (retries, duplicate charges, second campaigns) come from one scan: a
constant list of variants is exploded next to each row and filtered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallywork.functions import null_sentinel
from tallywork.session import input_size
from tallywork.sources.readers import conform
from tallywork.sources.schemas import SCHEMAS

# The benchmark columns the feeds use; a declared schema saves a job per read.
_BENCH = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# What the rules read.  Every other category is a number of its kind, as in "zone-2".
#   order, trip, enrolment and lesson status: completed, confirmed, cancelled, placed, started; payment status: succeeded, captured, failed, paid,
#   past_due; account status: active, cancelled; disconnect reason: voluntary, involuntary, ported_out; attempt status: submitted, graded;
#   currency: USD, EUR, GBP.


def _after(ts: str, days="0", hours="0", mins="0") -> str:
    return f"{ts} + make_dt_interval(CAST({days} AS int), CAST({hours} AS int), CAST({mins} AS int))"


def _elt(index: str, names: str) -> str:
    return f"elt(CAST({index} AS int) + 1, {names})"


def _code(kind: str, number: str) -> str:
    return f"concat('{kind}-', CAST({number} AS bigint))"


def _columns(text: str) -> list[str]:
    """One column per line."""
    return [line.strip() for line in text.strip().splitlines()]


def _variants(df: DataFrame, names: str, rows: list[str], keep: str) -> DataFrame:
    """Every row next to a constant list of variants, where ``keep`` says which ones apply."""
    aliases = [n.strip() for n in names.split(",")]
    structs = [
        "struct(" + ", ".join(f"{v.strip()} AS {a}" for v, a in zip(row.split(","), aliases)) + ")" for row in rows
    ]
    return df.selectExpr("*", f"inline(array({', '.join(structs)}))").where(keep)


class LazyTables(Mapping):
    """Raw tables of a domain, each built when it is first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


class Feeds:
    """Raw feeds of the four domains over one folder of benchmark tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._raw = {domain: self._domain(domain) for domain in SCHEMAS}

    def _domain(self, domain: str) -> LazyTables:
        def maker(name, schema):
            return lambda: conform(getattr(self, f"{domain}_{name.removeprefix('raw_')}")(), schema)

        return LazyTables({name: maker(name, schema) for name, schema in SCHEMAS[domain].items()})

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_BENCH[name]).parquet(f"{self.folder}/{name}.parquet")

    def parts(self, table: str, each: int = 2 * 2**20) -> int:
        """Partitions for what is made of a table: the session's number, or one per ``each`` bytes of its files if that is more."""
        stored = input_size(self.spark, f"{self.folder}/{table}.parquet")
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-stored // each))

    def raw(self, domain: str) -> LazyTables:
        return self._raw[domain]

    # ---- commerce -------------------------------------------------------------------

    def commerce_orders(self) -> DataFrame:
        stamped = self.table("orders").selectExpr(
            "o_orderkey AS order_id", "o_custkey AS customer_id", "CAST(o_totalprice AS decimal(12,2)) AS order_amount",
            "o_orderpriority AS priority", "o_orderstatus AS shelf",
            f"{_after('o_orderdate', mins='o_orderkey % 1440')} AS created_at",
        )
        return stamped.selectExpr("*", *_columns(f"""
            CASE left(priority, 1) WHEN '5' THEN 'cancelled' WHEN '4' THEN 'placed' WHEN '3' THEN 'confirmed' ELSE 'completed' END AS order_status
            CASE customer_id % 7 WHEN 5 THEN 'EUR' WHEN 6 THEN 'GBP' ELSE 'USD' END AS currency
            {_after('created_at', hours='if(order_id % 499 = 0, -5, 30)')} AS updated_at
        """))

    def _paid_orders(self) -> DataFrame:
        settled = self.commerce_orders().selectExpr("*", "order_status IN ('completed', 'confirmed') AS settled")
        return settled.selectExpr(
            "*",
            "settled OR (order_status = 'cancelled' AND shelf = 'F') OR (order_status = 'placed' AND shelf = 'P') AS paid",
        )

    def commerce_payments(self) -> DataFrame:
        attempts = _variants(
            self._paid_orders(), "n, payment_status, mins",
            ["1, 'failed', 10", "2, 'failed', 20", "3, 'succeeded', 40", "4, 'succeeded', 41"],
            "CASE n WHEN 1 THEN order_id % 11 IN (3, 7) WHEN 2 THEN order_id % 11 = 7 WHEN 3 THEN paid "
            "ELSE settled AND order_id % 23 = 0 END",
        )
        return attempts.selectExpr(*_columns(f"""
            order_id * 10 + n AS payment_id
            order_id
            payment_status
            order_amount AS amount
            currency
            {_code('pay', 'order_id % 4')} AS payment_method
            CAST(order_amount * 0.0175 + 0.15 AS decimal(12,2)) AS gateway_fee
            {_after('created_at', mins='mins')} AS attempted_at
            CASE WHEN payment_status = 'succeeded' THEN {_after('created_at', mins='mins + 1')} END AS processed_at
        """))

    def commerce_refunds(self) -> DataFrame:
        refunded = "paid AND CASE order_status WHEN 'cancelled' THEN order_id % 5 < 4 ELSE order_id % 13 = 0 END"
        return self._paid_orders().where(refunded).selectExpr(*_columns(f"""
            order_id AS refund_id
            order_id
            order_id * 10 + 3 AS payment_id
            CASE WHEN order_id % 3 = 0 THEN CAST(order_amount * 0.5 AS decimal(12,2)) ELSE order_amount END AS refund_amount
            currency
            {_code('reason', 'order_id % 5')} AS refund_reason
            'completed' AS refund_status
            {_after('created_at', days='order_id % 6 * 10', mins='41')} AS requested_at
            {_after('created_at', days='order_id % 6 * 11', mins='101')} AS processed_at
        """))

    def commerce_shipping(self) -> DataFrame:
        shipped = self._paid_orders().where("paid AND (order_status <> 'cancelled' OR order_id % 5 = 0)")
        parcels = _variants(shipped, "n", ["0", "1"], "n = 0 OR order_id % 37 = 0")
        return parcels.selectExpr(*_columns(f"""
            order_id * 2 + n AS shipment_id
            order_id
            {_code('carrier', 'order_id % 4')} AS carrier
            CAST(order_id % 7 + 4.99 AS decimal(12,2)) AS shipping_cost
            {_code('step', 'if(n = 1 OR order_id % 8 = 0, 2, 1)')} AS status
            CASE WHEN order_id % 7 <> 3 THEN {_after('created_at', days='2 + n')} END AS shipped_at
            CASE WHEN order_id % 5 <> 1 THEN {_after('created_at', days='6 + n')} END AS delivered_at
        """))

    # ---- rides ----------------------------------------------------------------------

    def rides_trips(self) -> DataFrame:
        priced = self.table("orders").selectExpr(
            "o_orderkey AS k", "o_custkey AS c", "CAST(o_totalprice AS decimal(12,2)) AS price",
            "o_orderkey % 6 = 0 AS off", f"{_after('o_orderdate', mins='o_orderkey % 1440')} AS requested_at",
        )
        return priced.selectExpr(*_columns(f"""
            k AS trip_id
            c AS rider_id
            k % 97 AS driver_id
            {_code('zone', 'c % 4')} AS city
            {_code('tier', 'k % 4')} AS product
            if(off, 'cancelled', 'completed') AS trip_status
            CASE WHEN off THEN {_code('cause', 'k % 5')} END AS cancel_reason
            CASE WHEN off AND (k % 5 = 2 OR k % 7 < 3) THEN 0 WHEN off THEN CAST(price * 0.25 AS decimal(12,2)) ELSE price END AS gross_fare
            k % 5 * 0.25 + 1.00 AS surge_multiplier
            if(c % 4 = 2, 'GBP', 'USD') AS currency
            CASE WHEN k % 1009 <> 0 THEN NOT off AND k % 31 = 0 END AS is_fraud_flagged
            k % 1000 * 0.0001 + 40 AS pickup_lat
            c % 1000 * 0.0001 - 74 AS pickup_lon
            k % 777 * 0.0002 + 40 AS dropoff_lat
            c % 555 * 0.0002 - 74 AS dropoff_lon
            requested_at
            {_after('requested_at', mins='if(k % 499 = 0, -2, 3)')} AS accepted_at
            CASE WHEN NOT off THEN {_after('requested_at', mins='10')} END AS started_at
            CASE WHEN NOT off THEN {_after('requested_at', mins='35')} END AS ended_at
        """))

    def rides_riders(self) -> DataFrame:
        loaded = self.table("customer").selectExpr(*_columns(f"""
            c_custkey AS rider_id
            {_code('zone', 'c_custkey % 4')} AS home_city
            CASE WHEN c_custkey % 50 = 7 THEN 'account-0' WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN lower(c_mktsegment) ELSE 'active' END AS account_status
            {_after("timestamp_ntz'1994-01-01'", days='c_custkey % 700')} AS signup_at
            if(c_custkey % 4 = 1, c_custkey - 1, -1) AS referred_by
        """))
        # The feed writes -1 for riders nobody referred.
        return loaded.withColumn("referred_by", null_sentinel(loaded["referred_by"], -1))

    def rides_drivers(self) -> DataFrame:
        onboarded = _variants(self.table("supplier"), "n", ["0", "1"], "n = 0 OR s_suppkey % 25 = 0")
        return onboarded.selectExpr(*_columns(f"""
            s_suppkey AS driver_id
            {_code('zone', 's_suppkey % 4')} AS home_city
            {_code('state', 'CASE WHEN s_suppkey % 20 = 3 THEN 2 WHEN s_suppkey % 13 = 5 THEN 1 ELSE 0 END')} AS driver_status
            s_suppkey % 111 * 0.01 + 3.90 AS rating
            {_after("timestamp_ntz'1993-01-01'", days='s_suppkey % 400 + 500 * n')} AS onboarded_at
            {_code('class', '(s_suppkey + n) % 3')} AS vehicle_class
        """))

    def rides_payments(self) -> DataFrame:
        attempts = _variants(
            self.rides_trips().where("gross_fare > 0"), "n, payment_status, mins",
            ["1, 'failed', 40", "2, 'failed', 45", "3, 'captured', 50", "4, 'captured', 51"],
            "CASE n WHEN 1 THEN trip_id % 11 IN (3, 7) WHEN 2 THEN trip_id % 11 = 7 WHEN 3 THEN trip_id % 14 <> 0 "
            "ELSE trip_id % 14 <> 0 AND trip_id % 29 = 0 END",
        )
        return attempts.selectExpr(*_columns(f"""
            trip_id * 10 + n AS payment_id
            trip_id
            rider_id
            payment_status
            gross_fare AS amount
            currency
            {_code('pay', 'trip_id % 4')} AS payment_method
            CAST(gross_fare * 0.0125 + 0.05 AS decimal(12,2)) AS processor_fee
            {_after('requested_at', mins='mins')} AS attempted_at
            CASE WHEN payment_status = 'captured' AND trip_status = 'completed' THEN {_after('requested_at', mins='mins + 1')} END AS captured_at
        """))

    def rides_driver_incentives(self) -> DataFrame:
        rewarded = self.rides_trips().where("trip_status = 'completed' AND trip_id % 3 = 0")
        lines = _variants(rewarded, "n", ["0", "1"], "n = 0 OR trip_id % 11 = 0")
        return lines.selectExpr(*_columns(f"""
            trip_id * 2 + n AS incentive_id
            driver_id
            trip_id
            {_code('campaign', '(trip_id + n) % 5')} AS campaign
            (trip_id % 9 + n) * 0.75 + 2.50 AS bonus_amount
            currency
            ended_at AS earned_at
            {_after('ended_at', days='trip_id % 35 + 3', hours='(trip_id + n) % 24')} AS paid_at
        """))

    # ---- telecom --------------------------------------------------------------------

    def telecom_subscribers(self) -> DataFrame:
        lines = _variants(self.table("customer"), "n", ["0", "1"], "n = 0 OR c_custkey % 50 = 0")
        marked = lines.selectExpr("c_custkey AS c", "n", "n = 0 AND c_custkey % 7 = 0 AS gone")
        return marked.selectExpr(*_columns(f"""
            c AS subscriber_id
            concat('Brand#', CAST(c % 25 + 1 AS string)) AS plan_code
            {_code('region', 'c % 5')} AS region
            if(gone, 'cancelled', 'active') AS account_status
            c % 2 = 0 AS autopay_enrolled
            CASE WHEN gone AND c % 49 <> 0 THEN {_elt('c % 3', "'voluntary', 'involuntary', 'ported_out'")} END AS disconnect_reason
            {_after("timestamp_ntz'2023-01-01'", days='c % 365 + 40 * n')} AS activated_at
            CASE WHEN gone THEN {_after("timestamp_ntz'2023-12-01'", days='c % 60')} END AS cancelled_at
        """))

    def telecom_plans(self) -> DataFrame:
        brands = self.table("part").groupBy("p_brand").agg({"p_retailprice": "min", "p_size": "max", "p_partkey": "min"})
        return brands.selectExpr(*_columns("""
            p_brand AS plan_code
            concat('type-', `min(p_partkey)` % 2) AS plan_type
            CAST(`min(p_retailprice)` AS decimal(12,2)) AS monthly_recurring_charge
            `max(p_size)` AS data_allowance_gb
            `min(p_partkey)` % 3 * 12 AS contract_months
        """))

    def telecom_usage(self) -> DataFrame:
        return self.table("events").where("event_type <> 'error'").selectExpr(
            "event_id AS usage_id", "user_id * 10 AS subscriber_id", "event_type AS usage_type",
            "round(value / 10) AS usage_units", "ts AS usage_date",
        )

    def telecom_payments(self) -> DataFrame:
        cycles = _variants(
            self.table("customer"), "n, billing_period, retry",
            [f"{n}, '{month}', {retry}" for n, month in [(1, "2023-11"), (2, "2023-12"), (3, "2024-01")] for retry in ("false", "true")],
            "NOT retry OR ((c_custkey + n) % 9 = 0 AND c_custkey % 2 = 0)",
        )
        charged = cycles.selectExpr("c_custkey AS c", "n", "billing_period", "retry", *_columns(f"""
            CASE WHEN retry THEN 'paid' WHEN (n = 3 AND c_custkey % 11 = 0) OR (n = 2 AND c_custkey % 55 = 0) THEN 'past_due' WHEN (c_custkey + n) % 9 = 0 THEN 'failed' ELSE 'paid' END AS payment_status
            {_after("timestamp_ntz'2023-11-15'", days='30 * (n - 1)')} AS due_at
        """))
        return charged.selectExpr(*_columns(f"""
            c * 10 + n + if(retry, 5, 0) AS payment_id
            c AS subscriber_id
            billing_period
            c % 30 + 20.00 AS amount_due
            payment_status
            {_code('pay', 'c % 4')} AS payment_method
            due_at
            CASE WHEN payment_status = 'paid' THEN {_after('due_at', days='if(retry, 5, 2)')} END AS paid_at
        """))

    def telecom_support_tickets(self) -> DataFrame:
        return self.table("events").where("event_type = 'error'").selectExpr(*_columns(f"""
            event_id AS ticket_id
            user_id * 10 AS subscriber_id
            {_code('topic', 'event_id % 6')} AS category
            {_code('channel', 'event_id % 5')} AS channel
            ts AS opened_at
            CASE WHEN event_id % 10 <> 0 THEN {_after('ts', hours='event_id % 72')} END AS resolved_at
        """))

    # ---- learning -------------------------------------------------------------------

    def learning_students(self) -> DataFrame:
        return self.table("orders").selectExpr(*_columns(f"""
            o_orderkey AS enrollment_id
            o_custkey AS student_id
            if(o_orderkey % 997 = 0, -1, o_orderkey % 200) AS course_id
            {_code('plan', 'o_orderkey % 3')} AS plan
            {_code('locale', 'o_orderkey % 4')} AS locale
            if(o_orderkey % 5 = 0, 'completed', {_code('state', 'o_orderkey % 5')}) AS enrollment_status
            o_orderdate AS enrolled_at
            {_after('o_orderdate', days='if(o_orderkey % 499 = 0, -1, o_orderkey % 90)')} AS last_active_at
        """))

    def learning_courses(self) -> DataFrame:
        return self.table("part").selectExpr(*_columns(f"""
            p_partkey AS course_id
            p_name AS course_title
            {_code('field', 'p_partkey % 4')} AS category
            if(p_partkey % 50 = 7, 2, p_partkey % 4 + 7) AS lesson_count
            70 AS pass_threshold
            p_partkey % 10 <> 9 AS is_active
            {_after("timestamp_ntz'1994-01-01'", days='p_partkey % 365')} AS created_at
        """))

    def learning_lessons(self) -> DataFrame:
        events = self.table("lineitem").selectExpr(
            "*", f"{_after('l_shipdate', mins='l_partkey % 600')} AS started_at"
        )
        return events.selectExpr(*_columns(f"""
            (l_orderkey * 8 + l_linenumber) * 4194304 + (l_partkey * 40503 + l_suppkey * 977 + dayofyear(l_shipdate) * 31) % 4194304 AS lesson_event_id
            l_orderkey AS enrollment_id
            l_orderkey AS student_id
            l_orderkey % 200 AS course_id
            l_linenumber AS lesson_number
            {_code('kind', 'l_partkey % 4')} AS lesson_type
            if(l_partkey % 19 = 0, 'started', 'completed') AS lesson_status
            {_code('device', 'l_suppkey % 3')} AS device
            l_quantity AS duration_minutes
            started_at
            CASE WHEN l_partkey % 19 <> 0 AND l_partkey % 17 <> 0 THEN {_after('started_at', mins='l_quantity')} END AS completed_at
        """))

    def learning_assessments(self) -> DataFrame:
        attempts = _variants(
            self.learning_students(), "n", ["0", "1"], "CASE n WHEN 0 THEN enrollment_id % 3 = 0 ELSE enrollment_id % 9 = 0 END"
        )
        scored = attempts.selectExpr(
            "*", "CASE WHEN n = 1 THEN enrollment_id % 31 + 70 WHEN enrollment_id % 41 <> 0 THEN enrollment_id % 66 + 35 END AS score",
            f"{_after('enrolled_at', days='30 + 7 * n')} AS submitted_at",
        )
        return scored.selectExpr(*_columns(f"""
            enrollment_id * 2 + n AS assessment_attempt_id
            enrollment_id
            student_id
            course_id
            'kind-0' AS assessment_type
            score
            70 AS pass_threshold
            score >= 70 AS is_passed
            if(score IS NULL, 'submitted', 'graded') AS attempt_status
            submitted_at
            CASE WHEN score IS NOT NULL THEN {_after('submitted_at', days='1')} END AS graded_at
        """))

    # ---- exchange rates -------------------------------------------------------------

    def fx_quotes(self) -> DataFrame:
        """Weekday quotes per currency on every day that has orders."""
        days = self.table("orders").selectExpr("CAST(o_orderdate AS date) AS rate_date").distinct()
        bases = "inline(array(struct('EUR' AS currency, 1.05 AS base), struct('GBP' AS currency, 1.20 AS base)))"
        return days.where("weekday(rate_date) < 5").selectExpr("rate_date", bases).selectExpr(
            "rate_date", "currency", "CAST(base + dayofmonth(rate_date) * 0.001 AS decimal(6,3)) AS rate"
        )


class StreamFeeds(Feeds):
    """The same feeds as streams over the files of the benchmark tables; those made by aggregation stay out of reach."""

    def table(self, name: str) -> DataFrame:
        reader = self.spark.readStream.schema(_BENCH[name]).option("pathGlobFilter", f"{name}.parquet")
        return reader.parquet(self.folder)

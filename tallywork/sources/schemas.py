"""Declared schemas of the raw tables the four domains read."""

from __future__ import annotations

from pyspark.sql import types as T

# Short names for the types the feeds use: money is exact, timestamps carry no zone.
_TYPES = {
    "id": T.LongType(), "money": T.DecimalType(12, 2), "units": T.DecimalType(14, 3), "rating": T.DecimalType(4, 2),
    "factor": T.DecimalType(5, 2), "degrees": T.DecimalType(9, 6), "ts": T.TimestampNTZType(),
    "text": T.StringType(), "flag": T.BooleanType(), "int": T.IntegerType(),
}

# Column names and types of the feeds; the first column is the declared key.
_COLUMNS = {
    "commerce": {
        "raw_orders": "order_id:id customer_id:id order_status:text order_amount:money currency:text "
                      "created_at:ts updated_at:ts",
        "raw_payments": "payment_id:id order_id:id payment_status:text amount:money currency:text "
                        "payment_method:text gateway_fee:money attempted_at:ts processed_at:ts",
        "raw_refunds": "refund_id:id order_id:id payment_id:id refund_amount:money currency:text "
                       "refund_reason:text refund_status:text requested_at:ts processed_at:ts",
        "raw_shipping": "shipment_id:id order_id:id carrier:text shipping_cost:money status:text "
                        "shipped_at:ts delivered_at:ts",
    },
    "rides": {
        "raw_riders": "rider_id:id home_city:text account_status:text signup_at:ts referred_by:id",
        "raw_drivers": "driver_id:id home_city:text driver_status:text rating:rating onboarded_at:ts "
                       "vehicle_class:text",
        "raw_trips": "trip_id:id rider_id:id driver_id:id city:text product:text trip_status:text "
                     "cancel_reason:text gross_fare:money surge_multiplier:factor currency:text "
                     "is_fraud_flagged:flag pickup_lat:degrees pickup_lon:degrees dropoff_lat:degrees "
                     "dropoff_lon:degrees requested_at:ts accepted_at:ts started_at:ts ended_at:ts",
        "raw_payments": "payment_id:id trip_id:id rider_id:id payment_status:text amount:money currency:text "
                        "payment_method:text processor_fee:money attempted_at:ts captured_at:ts",
        "raw_driver_incentives": "incentive_id:id driver_id:id trip_id:id campaign:text bonus_amount:money "
                                 "currency:text earned_at:ts paid_at:ts",
    },
    "telecom": {
        "raw_subscribers": "subscriber_id:id plan_code:text region:text account_status:text "
                           "autopay_enrolled:flag disconnect_reason:text activated_at:ts cancelled_at:ts",
        "raw_plans": "plan_code:text plan_type:text monthly_recurring_charge:money data_allowance_gb:id "
                     "contract_months:int",
        "raw_usage": "usage_id:id subscriber_id:id usage_type:text usage_units:units usage_date:ts",
        "raw_support_tickets": "ticket_id:id subscriber_id:id category:text channel:text opened_at:ts "
                               "resolved_at:ts",
        "raw_payments": "payment_id:id subscriber_id:id billing_period:text amount_due:money "
                        "payment_status:text payment_method:text due_at:ts paid_at:ts",
    },
    "learning": {
        "raw_students": "enrollment_id:id student_id:id course_id:id plan:text locale:text "
                        "enrollment_status:text enrolled_at:ts last_active_at:ts",
        "raw_courses": "course_id:id course_title:text category:text lesson_count:int pass_threshold:int "
                       "is_active:flag created_at:ts",
        "raw_lessons": "lesson_event_id:id enrollment_id:id student_id:id course_id:id lesson_number:int "
                       "lesson_type:text lesson_status:text device:text duration_minutes:int started_at:ts "
                       "completed_at:ts",
        "raw_assessments": "assessment_attempt_id:id enrollment_id:id student_id:id course_id:id "
                           "assessment_type:text score:int pass_threshold:int is_passed:flag "
                           "attempt_status:text submitted_at:ts graded_at:ts",
    },
}


def _struct(columns: str) -> T.StructType:
    pairs = [column.split(":") for column in columns.split()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, dict[str, T.StructType]] = {
    domain: {table: _struct(columns) for table, columns in tables.items()} for domain, tables in _COLUMNS.items()
}

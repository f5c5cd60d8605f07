from tallywork.functions.aggregates import (
    any_true, cond_count, cond_sum, max_if, max_str, min_if, n_distinct, n_distinct_if, row_count, span, sum_expr,
)
from tallywork.functions.geo import haversine_km
from tallywork.functions.logic import (
    all_of, any_of, at_least, classify, is_missing, is_present, null_sentinel, out_of_order, route_measure, truthy,
)
from tallywork.functions.money import FIXED_RATES, GBP_ONLY, fx_rate, pct, pct0, to_usd
from tallywork.functions.times import active_since, in_closed_range, lag_days, month_of, ntz

__all__ = [
    "FIXED_RATES", "GBP_ONLY", "active_since", "all_of", "any_of", "any_true", "at_least", "classify", "cond_count",
    "cond_sum", "fx_rate", "haversine_km", "in_closed_range", "is_missing", "is_present", "lag_days", "max_if",
    "max_str", "min_if", "month_of", "n_distinct", "n_distinct_if", "ntz", "null_sentinel", "out_of_order", "pct",
    "pct0", "route_measure", "row_count", "span", "sum_expr", "to_usd", "truthy",
]

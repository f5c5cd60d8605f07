from tallywork.operators.actives import trailing_actives
from tallywork.operators.asof import daily_rates, known_rates, rate_as_known, rate_as_of
from tallywork.operators.bridge import (
    bridge, gap_ties, gap_trend, partition_check, rank_drivers, robust_trend, run_trend, tie_out,
)
from tallywork.operators.dedup import (
    dedup_business_key, dedup_latest, dedup_priority, first_success_rollup, flag_multi, flag_primary,
    flag_primary_completion, keep_first, with_group_stats,
)
from tallywork.operators.definitions import (
    define_flags, definition_spread, overlap_matrix, overlap_summary,
)
from tallywork.operators.history import flag_events, restated, validity
from tallywork.operators.matching import match_lines, match_summary
from tallywork.operators.profile import dup_keys, profile, value_counts
from tallywork.operators.quality import (
    Check, DataQualityError, accepted, enforce, expression, freshness, generic_warn, not_null, observable, orphans,
    relationship, run_checks, tie_out_check, unique,
)
from tallywork.operators.rollup import best_outcome, by_month, fan_in, fill, lookup, summarize, with_boundary
from tallywork.operators.sketches import merge_sketches, sketch, sketch_report

__all__ = [
    "Check", "DataQualityError", "accepted", "best_outcome", "bridge", "by_month", "daily_rates",
    "dedup_business_key", "dedup_latest", "dedup_priority", "define_flags", "definition_spread", "dup_keys",
    "enforce", "expression", "fan_in", "fill", "first_success_rollup", "flag_events", "flag_multi", "flag_primary",
    "flag_primary_completion", "freshness", "generic_warn", "gap_ties", "gap_trend", "keep_first", "known_rates", "lookup", "match_lines", "match_summary", "merge_sketches", "not_null", "observable", "orphans",
    "overlap_matrix", "overlap_summary", "partition_check", "profile", "rank_drivers", "rate_as_known", "rate_as_of", "relationship", "restated", "robust_trend",
    "run_checks", "run_trend", "sketch", "sketch_report", "summarize", "tie_out", "tie_out_check", "trailing_actives", "unique", "validity", "value_counts", "with_boundary", "with_group_stats",
]

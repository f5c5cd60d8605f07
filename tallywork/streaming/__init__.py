from tallywork.streaming.arrivals import arrival_counts, collect_arrivals, compact, kept_rows
from tallywork.streaming.tie_out import unmatched_within
from tallywork.streaming.usage import daily_usage, read_stream, replay_dedup, run_available, with_end

__all__ = ["arrival_counts", "collect_arrivals", "compact", "daily_usage", "kept_rows", "read_stream", "replay_dedup", "run_available", "unmatched_within", "with_end"]

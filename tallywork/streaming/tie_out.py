"""A tie-out on two streams: what should have had a counterpart by now and has none."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unmatched_within(due: DataFrame, done: DataFrame, key: str, due_time: str, done_time: str, within: str, delay: str = "1 day") -> DataFrame:
    """Rows of ``due`` without a row of ``done`` of the same key at their time or up to ``within`` later.

    A stream-stream left outer join: both sides may arrive out of order by ``delay``, and a row comes out once the border has passed the
    end of its time, so state holds the rows of ``within`` and ``delay`` and no more.  Rows with a NULL key have no counterpart and come out
    at once; so does the row of ``with_end``, which callers leave out.
    """
    left = due.withColumn(due_time, F.col(due_time).cast("timestamp")).withWatermark(due_time, delay)
    right = done.select(F.col(key).alias("__key"), F.col(done_time).cast("timestamp").alias("__time")).withWatermark("__time", delay)
    # NULL-safe, or Spark would drop rows without a key before they can move the border, as the row of ``with_end`` does.
    on = F.expr(f"`{key}` <=> __key AND `{key}` IS NOT NULL AND __time >= `{due_time}` AND __time <= `{due_time}` + INTERVAL {within}")
    return left.join(right, on, "leftOuter").where("__time IS NULL").select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == due_time else F.col(c) for c in due.columns])

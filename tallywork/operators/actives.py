"""Distinct active people over trailing days, exactly, without a row per day and person."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tallywork.operators.rollup import with_boundary


def trailing_actives(activity: DataFrame, person: str, day: str, windows: Sequence[int]) -> DataFrame:
    """``day, active_<n>d, ...``: people with activity on the day or the ``n - 1`` days before, for every day of the calendar.

    The calendar runs from the first to the last day with activity.  People are long ids; rows without id or day take no part.  Ids
    are set in bitmaps, one per day and block of 32,768 ids, and a window over the days of a block joins them with OR.  A task sends a
    bitmap per day and block, however many rows it has read, and a window holds the days of one block, so its size is the calendar's.
    """
    base = activity.select(F.col(person).cast("long").alias("id"), F.col(day).cast("date").alias("day")).where("id IS NOT NULL AND day IS NOT NULL")
    maps = base.groupBy("day", F.bitmap_bucket_number("id").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("seen"))
    calendar = maps.agg(F.struct(F.min("day").alias("first"), F.max("day").alias("last")))
    blocks = with_boundary(maps.select("block").distinct(), "calendar", calendar)
    every = blocks.select("block", F.explode(F.sequence("calendar.first", "calendar.last")).alias("day")).join(maps, ["block", "day"], "left")
    trailing = lambda n: F.bitmap_or_agg("seen").over(W.partitionBy("block").orderBy("day").rowsBetween(1 - n, 0))
    held = every.select("day", *[F.bitmap_count(trailing(n)).alias(f"active_{n}d") for n in windows])
    return held.groupBy("day").agg(*[F.coalesce(F.sum(f"active_{n}d"), F.lit(0)).alias(f"active_{n}d") for n in windows])

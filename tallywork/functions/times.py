"""Calendar expressions on ``timestamp_ntz``, independent of the session time zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def ntz(value: str | date | datetime | Column) -> Column:
    column = value if isinstance(value, Column) else F.lit(str(value))
    return column.cast("timestamp_ntz")


def month_of(ts: Column) -> Column:
    """First instant of the month; goes through DATE, as date_trunc would give a zoned timestamp."""
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def lag_days(start: Column, end: Column) -> Column:
    """Midnights between two instants: 23:00 to 01:00 is one day."""
    return F.datediff(end.cast("date"), start.cast("date"))


def in_closed_range(ts: Column, low, high) -> Column:
    """Closed range; a plain date as upper bound means its midnight, so later that day is outside."""
    return ts.between(ntz(low), ntz(high))


def active_since(ts: Column, anchor: Column, days: int) -> Column:
    """True when ``ts`` is at most ``days`` before ``anchor``; no timestamp means not active."""
    return F.coalesce(ts >= anchor - F.make_dt_interval(days=F.lit(days)), F.lit(False))

"""Bridges from one headline number to another, and the tie-outs that prove them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallywork.functions.money import pct
from tallywork.functions.times import month_of
from tallywork.operators.rollup import with_boundary


def bridge(
    df: DataFrame, period: Column, lines: Mapping[str, Column], start: str, end: str, gap: str, gap_pct: str,
    derived: Mapping[str, Column] | None = None, rate: Callable[[Column, Column], Column] = pct,
    period_col: str = "report_month",
) -> DataFrame:
    """One row per month: every line, the gap from ``start`` to ``end`` and its share of ``start``.

    ``lines`` are aggregates over the rows of the month; ``derived`` are expressions over
    the finished lines.  A single grouped aggregation, however many lines there are.
    """
    out = df.groupBy(month_of(period).alias(period_col)).agg(
        *[column.alias(name) for name, column in lines.items()]
    )
    if derived:
        out = out.withColumns(dict(derived))
    difference = F.col(start) - F.col(end)
    return out.withColumns({gap: difference, gap_pct: rate(difference, F.col(start))})


def gap_ties(df: DataFrame, start: str, end: str, gap: str, digits: int = 2, keep: Sequence[str] = ("report_month",)) -> DataFrame:
    """Per period: does the stated gap equal start minus end to the penny?"""
    expected = F.round(F.col(start) - F.col(end), digits)
    stated = F.round(F.col(gap), digits)
    return df.select(*keep, expected.alias("expected_gap"), stated.alias("stated_gap"), (expected == stated).alias("ties"))


def tie_out(mart: DataFrame, mart_total: Column, ledger: DataFrame, ledger_total: Column, tol="0") -> DataFrame:
    """One row: mart total, ledger total, difference, and whether they agree within ``tol``."""
    both = with_boundary(mart.agg(mart_total.alias("mart_total")), "ledger_total", ledger.agg(ledger_total))
    difference = F.coalesce(F.col("mart_total"), F.lit(0)) - F.coalesce(F.col("ledger_total"), F.lit(0))
    return both.withColumn("difference", difference).withColumn(
        "ties", F.abs(F.col("difference")) <= F.lit(Decimal(tol))
    )


def partition_check(df: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """Do the categories add up to the total, so that every row is in exactly one?"""
    summed = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return df.select(F.col(total).alias("total"), summed.alias("parts_sum"), (F.col(total) == summed).alias("partitions"))


def rank_drivers(df: DataFrame, period: str, lines: Sequence[str], gap: str) -> DataFrame:
    """Leakage lines of each period, largest first, with their share of the gap.

    The window holds one row per line of a finished bridge, never raw rows.
    """
    long = df.unpivot([period, gap], list(lines), "driver", "amount")
    window = W.partitionBy(period).orderBy(F.col("amount").desc_nulls_last(), F.col("driver").asc())
    return long.select(
        period, "driver", "amount",
        pct(F.col("amount"), F.col(gap)).alias("share_of_gap_pct"),
        F.row_number().over(window).alias("driver_rank"),
    )


def gap_trend(df: DataFrame, period: str, value: str, jump: str | float | Decimal) -> DataFrame:
    """Change of a percentage from the previous period, flagged when it moves by more than ``jump`` points.

    The input is a finished bridge: one row per calendar month, so the unpartitioned window
    is as long as the calendar, whatever the size of the data beneath.
    """
    previous = F.lag(value).over(W.orderBy(period))
    out = df.select(period, value).withColumn(f"previous_{value}", previous)
    change = F.col(value) - F.col(f"previous_{value}")
    return out.withColumns({
        "change_points": change,
        "is_anomaly": F.coalesce(F.abs(change) > F.lit(Decimal(str(jump))), F.lit(False)),
    })


def _median(values: Column) -> Column:
    """Of a sorted array; NULL where it is empty."""
    n = F.size(values)
    middle = F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))
    return F.when(n > 0, middle / 2)


def robust_trend(df: DataFrame, period: str, value: str, frame: int = 12, least: int = 6, limit: float = 3.0) -> DataFrame:
    """A value against its own past: ``baseline`` and ``spread`` of the ``frame`` periods before, ``score`` and ``is_anomaly``.

    The baseline is the median, the spread the median distance from it times 1.4826, which for a normal value is its standard
    deviation; one wild period moves neither.  Beyond ``limit`` spreads a value is an anomaly.  Where the past is constant any other value
    is one, without a score; with fewer than ``least`` known periods none is.  NULL values are no past and no anomaly.

    The input is a finished bridge, one row per period, so the unpartitioned window is as long as the calendar.
    """
    past = F.sort_array(F.collect_list(F.col(value).cast("double")).over(W.orderBy(period).rowsBetween(-frame, -1)))
    out = df.select(period, F.col(value).cast("double").alias(value), past.alias("__past"))
    out = out.withColumn("baseline", _median(F.col("__past")))
    distances = F.sort_array(F.transform("__past", lambda x: F.abs(x - F.col("baseline"))))
    out = out.withColumns({"n_past": F.size("__past"), "spread": F.round(_median(distances) * 1.4826, 6)})
    apart = F.abs(F.col(value) - F.col("baseline"))
    anomaly = F.when(F.col("spread") > 0, apart > limit * F.col("spread")).otherwise(apart > 0)
    return out.withColumns({
        "baseline": F.round("baseline", 6), "score": F.when(F.col("spread") > 0, F.round((F.col(value) - F.col("baseline")) / F.col("spread"), 4)),
        "is_anomaly": F.coalesce((F.col("n_past") >= least) & anomaly, F.lit(False)),
    }).drop("__past")


def run_trend(history: DataFrame, subject: str, jump: str | float | Decimal, order: str = "ended_at") -> DataFrame:
    """Change of one subject of a run history from run to run, flagged when it moves by more than ``jump``.

    The input has a few rows per run, so the unpartitioned window is as long as the list of runs.
    """
    own = history.where(F.col("subject") == subject).select("run", order, F.col("value"))
    out = own.withColumn("previous_value", F.lag("value").over(W.orderBy(order)))
    change = F.col("value") - F.col("previous_value")
    return out.withColumns({"change": change, "is_anomaly": F.coalesce(F.abs(change) > F.lit(float(jump)), F.lit(False))})

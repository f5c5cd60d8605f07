"""Roll children up to the parent's grain and join them in."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallywork.functions.aggregates import any_true, cond_count, row_count
from tallywork.functions.times import month_of


def fan_in(parent: DataFrame, key: str, children: Iterable[DataFrame], parts: int | None = None) -> DataFrame:
    """Left-join children that already hold one row per key; no join can multiply rows.

    Each child leaves its aggregation partitioned by ``key``, so only the parent needs an
    exchange of its own.  With ``parts`` parent and children are dealt into so many partitions
    instead, so that the joins of a task stay small whatever the session's number is.
    """
    dealt = (lambda df: df.repartition(parts, key)) if parts else (lambda df: df)
    out = dealt(parent)
    for child in children:
        out = out.join(dealt(child), key, "left")
    return out


def fill(df: DataFrame, zeros: Sequence[str] = (), falses: Sequence[str] = ()) -> DataFrame:
    """Replace the NULLs a left join leaves by 0 or false."""
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in zeros}
    filled |= {c: F.coalesce(F.col(c), F.lit(False)) for c in falses}
    return df.withColumns(filled) if filled else df


def lookup(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Dimension lookup.

    No broadcast hint: Spark broadcasts by measured size and otherwise shuffles both sides,
    where adaptive execution splits a hot key.
    """
    return df.join(dim, key, "left")


def with_boundary(df: DataFrame, name: str, boundary: DataFrame) -> DataFrame:
    """Put a one-value aggregate on every row, as a scalar subquery that runs once."""
    return df.withColumn(name, boundary.scalar())


def summarize(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One-row summary of the whole table."""
    return df.agg(*[column.alias(name) for name, column in measures.items()])


def by_month(df: DataFrame, ts: Column, measures: Mapping[str, Column], month_col: str = "report_month") -> DataFrame:
    return df.groupBy(month_of(ts).alias(month_col)).agg(
        *[column.alias(name) for name, column in measures.items()]
    )


def best_outcome(
    df: DataFrame, key: str, passed: str, score: str, ungraded: Column, first_ts: str, last_ts: str
) -> DataFrame:
    """Best result per key over all attempts: any graded pass counts."""
    return df.groupBy(key).agg(
        row_count().alias("total_attempts"),
        cond_count(ungraded).alias("ungraded_attempts"),
        any_true(F.col(passed)).alias("ever_passed"),
        F.max(score).alias("best_score"),
        F.min(first_ts).alias("first_attempt_at"),
        F.max(last_ts).alias("last_graded_at"),
    )

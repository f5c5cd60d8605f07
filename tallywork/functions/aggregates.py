"""Aggregate expressions; all of them pre-aggregate on the map side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def cond_count(condition: Column) -> Column:
    return F.count_if(condition)


def cond_sum(condition: Column, measure: Column) -> Column:
    return F.sum(F.when(condition, measure).otherwise(F.lit(0)))


def sum_expr(expression: Column) -> Column:
    return F.sum(expression)


def n_distinct(column: Column) -> Column:
    return F.count_distinct(column)


def n_distinct_if(condition: Column, column: Column) -> Column:
    return F.count_distinct(F.when(condition, column))


def max_if(condition: Column, column: Column) -> Column:
    return F.max(F.when(condition, column))


def min_if(condition: Column, column: Column) -> Column:
    return F.min(F.when(condition, column))


def any_true(condition: Column) -> Column:
    """True when the condition holds for any row; rows where it is unknown do not count."""
    return F.bool_or(F.coalesce(condition, F.lit(False)))


def max_str(column: Column) -> Column:
    """Any one value of the group, chosen as the lexicographically largest."""
    return F.max(column)


def span(ts: Column, first: str, last: str) -> list[Column]:
    return [F.min(ts).alias(first), F.max(ts).alias(last)]

"""Flags, ordered classification and boolean algebra with explicit NULL handling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F


def truthy(condition: Column) -> Column:
    """Three-valued condition to a two-valued flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def is_missing(column: Column) -> Column:
    return column.isNull()


def is_present(column: Column) -> Column:
    return column.isNotNull()


def out_of_order(earlier: Column, later: Column) -> Column:
    """Clock skew: the event that must come later is stamped before the earlier one."""
    return truthy(later < earlier)


def at_least(column: Column, threshold) -> Column:
    return truthy(column >= F.lit(threshold))


def null_sentinel(column: Column, value) -> Column:
    return F.nullif(column, F.lit(value))


def classify(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first rule that holds; NULL when none does and no default is given."""
    label = None
    for condition, name in rules:
        label = (F if label is None else label).when(condition, F.lit(name))
    return label if default is None else label.otherwise(F.lit(default))


def route_measure(measure: Column, routes: Mapping[str, Column]) -> dict[str, Column]:
    """Spread one measure over columns: the measure where the predicate holds, else 0."""
    return {name: F.when(condition, measure).otherwise(F.lit(0)) for name, condition in routes.items()}


def any_of(flags: Iterable[str]) -> Column:
    return reduce(or_, [F.col(flag) for flag in flags])


def all_of(flags: Iterable[str]) -> Column:
    return reduce(and_, [F.col(flag) for flag in flags])

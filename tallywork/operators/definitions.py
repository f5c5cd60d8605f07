"""Competing definitions of one concept, side by side, and where they disagree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallywork.functions.aggregates import cond_count, row_count
from tallywork.functions.logic import all_of, any_of, truthy
from tallywork.functions.money import pct


def define_flags(df: DataFrame, definitions: Mapping[str, Column]) -> DataFrame:
    """Add one flag per definition; an unknown condition is false."""
    return df.withColumns({name: truthy(condition) for name, condition in definitions.items()})


def overlap_summary(
    df: DataFrame, flags: Mapping[str, str], total: str, any_col: str, all_col: str, rates: Mapping[str, str] = {},
    extra: Mapping[str, Column] | None = None, digits: int = 2,
) -> DataFrame:
    """One row: size of every definition, of their union and intersection, and rates.

    ``flags`` maps output names to flag columns, ``rates`` maps rate names to output names.
    """
    counted = df.agg(
        row_count().alias(total),
        *[cond_count(F.col(flag)).alias(name) for name, flag in flags.items()],
        cond_count(any_of(flags.values())).alias(any_col),
        cond_count(all_of(flags.values())).alias(all_col),
        *[column.alias(name) for name, column in (extra or {}).items()],
    )
    return counted.withColumns({name: pct(F.col(size), F.col(total), digits) for name, size in rates.items()})


def overlap_matrix(df: DataFrame, flags: Sequence[str], count_col: str = "n") -> DataFrame:
    """Rows per pattern of flags: which definitions agree on how many rows."""
    return df.groupBy(*flags).agg(row_count().alias(count_col))


def definition_spread(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row that walks from the size of definition ``a`` to the size of ``b``."""
    in_a, in_b = F.col(a), F.col(b)
    counted = df.agg(
        cond_count(in_a).alias("in_a"),
        cond_count(in_a & ~in_b).alias("only_a"),
        cond_count(in_a & in_b).alias("in_both"),
        cond_count(in_b & ~in_a).alias("only_b"),
        cond_count(in_b).alias("in_b"),
    )
    return counted.withColumn("spread", F.col("in_b") - F.col("in_a"))

"""Table profile: what to look at before trusting a feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tallywork.functions.aggregates import row_count
from tallywork.functions.money import pct
from tallywork.operators.rollup import with_boundary


def profile(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per column: rows, distinct keys, nulls, and min/max/avg of numeric columns.

    One flat aggregation over the table, whose one-row result is turned on its side.  Distinct keys are counted apart from it,
    over the key columns alone, so the exchange for them carries nothing else.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    key_struct = F.struct(*key) if len(key) > 1 else F.col(key[0])
    keys = df.select(key_struct.alias("key")).where(F.col("key").isNotNull()).distinct().agg(row_count())
    aggregates = [row_count().alias("rows")]
    for i, name in enumerate(df.columns):
        aggregates.append(F.count_if(F.col(name).isNull()).alias(f"nulls_{i}"))
        if name in numeric:
            column = F.col(name)
            aggregates += [F.min(column).alias(f"min_{i}"), F.max(column).alias(f"max_{i}"), F.avg(column).alias(f"avg_{i}")]
    one_row = with_boundary(df.agg(*aggregates), "distinct_keys", keys)
    nothing = F.lit(None).cast("double")
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"nulls_{i}").alias("nulls"),
            *[
                (F.col(f"{kind}_{i}").cast("double") if name in numeric else nothing).alias(f"{kind}_value")
                for kind in ("min", "max", "avg")
            ],
        )
        for i, name in enumerate(df.columns)
    ]
    return one_row.select("rows", "distinct_keys", F.inline(F.array(*lines)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with the share of all rows."""
    counted = df.groupBy(F.col(column).alias("value")).agg(row_count().alias("n"))
    counted = with_boundary(counted, "__total", df.agg(row_count()))
    return counted.select("value", "n", pct(F.col("n"), F.col("__total")).alias("share_pct"))


def dup_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*key).agg(row_count().alias("n")).where(F.col("n") > 1)

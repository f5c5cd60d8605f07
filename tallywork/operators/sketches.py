"""Mergeable profile: quantile and distinct sketches as tables, kept per part of a feed and merged over parts and runs.

A sketch is a table (by..., ``column_name``, ``kind``, ``bucket``, ``n``).  ``nulls``, ``filled`` and ``nonfinite`` are counts.  ``values``
counts the values of each logarithmic bucket, so a quantile is off by a share of ``accuracy`` of its value at most.  ``distinct`` holds,
for each of ``registers`` registers, the longest run of leading zeros in the hashes dealt to it, which gives the number of distinct
values with a standard error of ``1.04 / sqrt(registers)``.  Counts add and registers take the larger one, so merging is one
aggregation and the order of merging does not matter.  A column has a bounded number of rows in a sketch, however long its
feed is, and they are aggregated before the exchange.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

ACCURACY = 0.01
REGISTERS = 2_048
_HASH_BITS = 52
_FIELDS = ("column_name", "kind", "bucket", "n")


def _log_base(accuracy: float) -> float:
    if not 0 < accuracy < 1:
        raise ValueError("accuracy is a share between 0 and 1")
    return math.log((1 + accuracy) / (1 - accuracy))


def _shift(accuracy: float) -> int:
    """Added to the exponent of a bucket, so that those of the smallest doubles are positive too: zero is bucket 0."""
    return math.ceil(746 / _log_base(accuracy)) + 1


def _bucket(x: Column, accuracy: float) -> Column:
    exponent = F.ceil(F.log(F.abs(x)) / F.lit(_log_base(accuracy))) + F.lit(_shift(accuracy))
    return F.when(x == 0, F.lit(0)).otherwise(F.signum(x).cast("bigint") * exponent).cast("bigint")


def _bucket_value(bucket: Column, accuracy: float) -> Column:
    base = _log_base(accuracy)
    size = F.exp((F.abs(bucket) - F.lit(_shift(accuracy))) * F.lit(base) + F.lit(math.log(2 / (1 + math.exp(base)))))
    return F.when(bucket == 0, F.lit(0.0)).otherwise(F.signum(bucket) * size)


def _combined() -> Column:
    return F.when(F.col("kind") == "distinct", F.max("n")).otherwise(F.sum("n")).alias("n")


def _check_names(by: Sequence[str]) -> None:
    if set(by) & set(_FIELDS):
        raise ValueError(f"rename the columns {sorted(set(by) & set(_FIELDS))} before they part a sketch")


def sketch(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), accuracy: float = ACCURACY, registers: int = REGISTERS,
) -> DataFrame:
    """Sketch of some columns (all but ``by``), one for each value of ``by``, NULL included.

    Distinct values are told apart by their text.  NaN and infinite values are counted as ``nonfinite`` and have no place among the
    quantiles; columns that are not numbers have no quantiles.  A table without rows has a sketch without rows.
    """
    _check_names(by)
    fields = [f for f in df.schema.fields if (f.name not in by if columns is None else f.name in columns)]
    marks = []
    for f in fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            column = column + F.lit(0.0)  # -0.0 and 0.0 are one value
        digest = F.md5(column.cast("string"))
        number = F.conv(F.substring(digest, 9, _HASH_BITS // 4), 16, 10).cast("bigint")
        zeros = F.when(number == 0, F.lit(_HASH_BITS + 1)).otherwise(F.lit(_HASH_BITS + 1) - F.length(F.bin(number)))
        register = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(registers)

        def mark(kind: Column, bucket: Column, n: Column, name: str = f.name) -> Column:
            return F.struct(
                F.lit(name).alias("column_name"), kind.alias("kind"), bucket.cast("bigint").alias("bucket"), n.cast("bigint").alias("n"),
            )

        one, zero, filled = F.lit(1), F.lit(0), column.isNotNull()
        marks.append(mark(F.when(filled, "filled").otherwise("nulls"), zero, one))
        marks.append(F.when(filled, mark(F.lit("distinct"), register, zeros)))
        if isinstance(f.dataType, T.NumericType):
            x = column.cast("double")
            finite = ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
            marks.append(F.when(filled, F.when(finite, mark(F.lit("values"), _bucket(x, accuracy), one)).otherwise(mark(F.lit("nonfinite"), zero, one))))
    if not marks:
        raise ValueError("no column to sketch")
    parts = [F.col(f"`{c}`") for c in by]
    marked = df.select(*parts, F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("__mark")).select(*parts, "__mark.*")
    return marked.groupBy(*parts, "column_name", "kind", "bucket").agg(_combined())


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts and runs, appended to each other, as the sketches of all their rows for each value of ``by``.

    All must have been made with one accuracy and one number of registers.  Columns that part them more finely are dropped.
    """
    _check_names(by)
    return sketches.groupBy(*[F.col(f"`{c}`") for c in by], "column_name", "kind", "bucket").agg(_combined())


def sketch_report(
    sketches: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = (0.5, 0.95, 0.99),
    accuracy: float = ACCURACY, registers: int = REGISTERS,
) -> DataFrame:
    """One row per value of ``by`` and column: rows, nulls, nonfinite, distinct_estimate, and q50, q95 ... of numbers.

    The quantile ``q`` of ``n`` values stands for the value of rank ``ceil(q * n)``, the smallest value for 0.
    """
    merged = merge_sketches(sketches, by)
    groups = [F.col(f"`{c}`") for c in by] + [F.col("column_name")]
    is_kind = lambda *kinds: F.col("kind").isin(*kinds)
    counted = F.when(is_kind("values"), F.col("n")).otherwise(0)
    # A window holds the buckets of one column, whose number is bounded.
    whole = Window.partitionBy(*groups)
    ranked = merged.withColumns({
        "__upto": F.sum(counted).over(whole.orderBy("kind", "bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__all": F.sum(counted).over(whole),
    })
    total = lambda *kinds: F.coalesce(F.sum(F.when(is_kind(*kinds), F.col("n"))), F.lit(0)).alias(kinds[0])
    found = {
        f"q{q * 100:g}".replace(".", "_"):
            F.min(F.when(is_kind("values") & (F.col("__upto") >= F.greatest(F.ceil(F.lit(float(q)) * F.col("__all")), F.lit(1))), F.col("bucket")))
        for q in quantiles
    }
    summed = ranked.groupBy(*groups).agg(
        total("filled", "nulls"), total("nulls"), total("nonfinite"), F.count_if(is_kind("distinct")).alias("__used"),
        F.coalesce(F.sum(F.when(is_kind("distinct"), F.pow(F.lit(2.0), -F.col("n")))), F.lit(0.0)).alias("__sum"),
        *[column.alias(name) for name, column in found.items()],
    )
    unused = F.lit(registers) - F.col("__used")
    raw = F.lit(0.7213 / (1 + 1.079 / registers) * registers * registers) / (F.col("__sum") + unused)
    small = F.lit(float(registers)) * F.log(F.lit(float(registers)) / unused)
    estimate = F.when((unused > 0) & (raw <= 2.5 * registers), small).otherwise(raw)
    return summed.select(
        *groups, F.col("filled").alias("rows"), "nulls", "nonfinite", F.round(estimate).cast("bigint").alias("distinct_estimate"),
        *[_bucket_value(F.col(name), accuracy).alias(name) for name in found],
    )

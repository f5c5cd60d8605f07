"""Deduplication with evidence: rank, flag and keep.

Ordering rule everywhere: NULL counts as the largest value, so it comes last when the
earliest row wins and first when the latest row wins.

Skew.  A window over a key puts all rows of that key in one task, however many there are.
None of these operators does that with raw rows:

* operators that keep one row per key either aggregate (partial aggregation before the
  exchange) or filter ``row_number() = 1``, which Spark limits per key before the exchange;
* operators that keep every row and only flag it compute one small row per key by
  aggregation and join it back.  The join is NULL-safe, so both sides get their own
  exchange and adaptive execution can split the tasks of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallywork.functions.aggregates import row_count


def _rank_key(order: Sequence[Column]) -> list[Column]:
    """Comparable fields in which NULL is larger than any value."""
    fields = []
    for i, column in enumerate(order):
        fields += [column.isNull().alias(f"__null{i}"), column.alias(f"__key{i}")]
    return fields


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def with_group_stats(
    df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column], lookup: DataFrame | None = None
) -> DataFrame:
    """Every row of ``df`` plus aggregates over its group; NULL keys form a group too.

    Columns of ``lookup``, a table with one row per key, are joined to the group first, so
    the rows themselves are shuffled once for both.
    """
    per_key = df.groupBy(*[F.col(k).alias(f"__on_{k}") for k in keys]).agg(
        *[column.alias(name) for name, column in stats.items()]
    )
    if lookup is not None:
        per_key = per_key.join(
            lookup.withColumnsRenamed({k: f"__on_{k}" for k in keys}), [f"__on_{k}" for k in keys], "left"
        )
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__on_{k}")) for k in keys])
    return df.join(per_key, same_key, "left").drop(*[f"__on_{k}" for k in keys])


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order`` (write directions and NULL places in it).

    The only window here is the rank with a limit of one, which Spark also applies on the
    map side, so at most one row per key and input task is shuffled.
    """
    window = W.partitionBy(*_columns(keys)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], count_col: str, flag_col: str | None = None
) -> DataFrame:
    """Latest row per key, with the number of rows it stands for.

    Ties on ``order`` are broken by the remaining columns, so the result does not depend
    on how the input is partitioned.
    """
    rest = [c for c in df.columns if c not in keys]
    latest = F.max(F.struct(*_rank_key(_columns(order)), *rest)).alias("__row")
    kept = df.groupBy(*keys).agg(latest, row_count().alias(count_col))
    out = kept.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest], count_col).select(*df.columns, count_col)
    return out.withColumn(flag_col, F.col(count_col) > 1) if flag_col else out


def dedup_priority(
    df: DataFrame, keys: Sequence[str], column: str, priority: Mapping[str, int], order: Sequence[str | Column],
    otherwise: int = 0,
) -> DataFrame:
    """Row with the highest-priority value per key, the latest one among equals."""
    weight = F.lit(otherwise)
    for value, points in priority.items():
        weight = F.when(F.col(column) == value, F.lit(points)).otherwise(weight)
    return keep_first(df, keys, [weight.desc(), *[c.desc_nulls_first() for c in _columns(order)]])


def dedup_business_key(
    df: DataFrame, key_exprs: Sequence[str | Column], order: Sequence[str | Column]
) -> DataFrame:
    """First row per business key; the key may hold expressions such as a truncated date."""
    return keep_first(df, key_exprs, [c.asc_nulls_last() for c in _columns(order)])


def flag_primary(
    df: DataFrame, keys: Sequence[str], status: str, success: str, order: Sequence[str | Column], count_col: str,
    duplicate_col: str, primary_col: str, passthrough: str = "failed",
) -> DataFrame:
    """Flag the first success per key as primary and keep every row.

    ``order`` must identify a row within its key (end it with the record id).  Rows in the
    ``passthrough`` status are primary as well; later successes are not.
    """
    is_success = F.col(status) == success
    rank = F.struct(*_rank_key(_columns(order)))
    counted = with_group_stats(
        df, keys, {"__first": F.min(F.when(is_success, rank)), count_col: F.count_if(is_success)}
    )
    primary = F.when(is_success, rank.eqNullSafe(F.col("__first"))).otherwise(
        F.coalesce(F.col(status) == passthrough, F.lit(False))
    )
    return counted.withColumns({duplicate_col: F.col(count_col) > 1, primary_col: primary}).drop("__first")


def first_success_rollup(
    df: DataFrame, keys: Sequence[str], status: str, success: str, order: Sequence[str | Column],
    measures: Mapping[str, Column], count_col: str, extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """What summing ``flag_primary`` successes per key gives, in one aggregation of the raw rows.

    Only the first success of a key contributes to ``measures``, so it is enough to carry
    its values along in the minimum; no row has to be ranked or joined back.
    """
    is_success = F.col(status) == success
    carried = [column.alias(name) for name, column in measures.items()]
    first = F.min(F.when(is_success, F.struct(*_rank_key(_columns(order)), *carried))).alias("__first")
    rolled = df.groupBy(*keys).agg(
        first,
        row_count().alias("__rows"),
        F.count_if(is_success).alias(count_col),
        *[column.alias(name) for name, column in (extra or {}).items()],
    )
    # A sum over one row with a NULL measure is NULL; any further row adds a zero.
    alone = (F.col("__rows") == 1) & (F.col(count_col) == 1)
    summed = {
        name: F.when(alone, F.col(f"__first.{name}")).otherwise(F.coalesce(F.col(f"__first.{name}"), F.lit(0)))
        for name in measures
    }
    return rolled.withColumns(summed).drop("__first", "__rows")


def flag_multi(
    df: DataFrame, keys: Sequence[str], count_col: str, flag_col: str, lookup: DataFrame | None = None
) -> DataFrame:
    """Number of lines per key on every line, whether there is more than one, and what ``lookup`` says of the key."""
    return with_group_stats(df, keys, {count_col: row_count()}, lookup).withColumn(flag_col, F.col(count_col) > 1)


def flag_primary_completion(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], status: str = "lesson_status",
    done: str = "completed", passthrough: str = "started", primary_col: str = "is_primary_completion",
    partition_by_status: bool = False,
) -> DataFrame:
    """Flag the first event per key as the primary completion and keep every event.

    By default all events of the key are ranked together, so a completion that follows a
    ``passthrough`` event is not primary; ``partition_by_status`` ranks completions alone.
    """
    is_done = F.col(status) == done
    rank = F.struct(*_rank_key(_columns(order)))
    first = F.min(F.when(is_done, rank)) if partition_by_status else F.min(rank)
    ranked = with_group_stats(df, keys, {"__first": first})
    primary = F.when(is_done, rank.eqNullSafe(F.col("__first"))).otherwise(
        F.coalesce(F.col(status) == passthrough, F.lit(False))
    )
    return ranked.withColumn(primary_col, primary).drop("__first")

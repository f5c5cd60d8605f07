"""History out of kept snapshots: validity intervals per row, and when a flag was set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tallywork.operators._union import union_all


def validity(snapshots: Mapping[datetime, DataFrame], keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys, columns, valid_from, valid_to`` of every row of some snapshots of one table, by the instants they were taken.

    An interval starts with the snapshot that first shows the content and ends with the first that shows another one or no row; it
    is open (NULL) while the last snapshot still shows it.  A row that comes back starts another interval.  NULL is a value
    like any other, in keys too, and repeated rows are one; a key with several contents in one snapshot has an interval for each.

    Contents are compared over all snapshots by one partial aggregation: a task sends a content once with the numbers of the snapshots
    that show it, so what is exchanged grows with what changed, and no window holds the rows of a key.
    """
    taken = sorted(snapshots)
    if not taken:
        raise ValueError("no snapshots")
    shown = union_all([snapshots[at].select(*keys, *columns, F.lit(i).alias("__at")) for i, at in enumerate(taken)])
    held = shown.groupBy(*keys, *columns).agg(F.sort_array(F.collect_set("__at")).alias("__in"))  # as long as the list of snapshots
    first = lambda x: ~F.array_contains("__in", x - 1)
    last = lambda x: ~F.array_contains("__in", x + 1)
    runs = F.arrays_zip(F.filter("__in", first).alias("a"), F.filter("__in", last).alias("b"))
    instants = F.array(*[F.lit(at) for at in taken])
    rows = held.select(*keys, *columns, F.explode(runs).alias("__run"))
    return rows.select(
        *keys, *columns, F.get(instants, F.col("__run.a")).cast("timestamp_ntz").alias("valid_from"),
        F.get(instants, F.col("__run.b") + 1).cast("timestamp_ntz").alias("valid_to"),
    )


def flag_events(snapshots: Mapping[datetime, DataFrame], keys: Sequence[str], flag: str) -> DataFrame:
    """``keys, event, at``: when snapshots first showed a flag on a key (``set``), and first no longer did (``cleared``).

    NULL counts as not set.  A key that is flagged in its first snapshot was set then, as far as the snapshots know; a key that
    disappears while it is flagged is cleared by that.  A flag on any of the rows of a key is on the key.
    """
    flagged = {at: df.where(F.col(flag)).select(*keys) for at, df in snapshots.items()}
    spans = validity(flagged, keys, [])
    event = lambda name, at: F.struct(F.lit(name).alias("event"), F.col(at).alias("at"))
    both = spans.select(*keys, F.explode(F.array(event("set", "valid_from"), event("cleared", "valid_to"))).alias("__event"))
    return both.select(*keys, "__event.event", "__event.at").where(F.col("at").isNotNull())


def restated(before: DataFrame, after: DataFrame, keys: Sequence[str], period: Column, category: Column, amount: Column, counts: Column, closed_through: Column) -> DataFrame:
    """Why the headline of each period changed from one run to the next: one row per period, with exact sums.

    A row adds ``amount`` to the headline of its ``period`` where ``counts`` (of its ``category``) holds.  Per key, NULL-safe:

    * ``late``: only in the later run, in a period the earlier one had closed (up to ``closed_through``); ``new`` where it was open;
    * ``withdrawn``: only in the earlier run;
    * ``moved``: another period: out of the old one, into the new one, at the old amount;
    * ``reclassified``: another category, at the old amount;
    * ``corrected``: what is left, another amount.

    Rows that repeat a key in one run are one row of their summed amount, first period and smallest category.  The two runs meet in
    one aggregation by key, so a hot key is summed in the tasks and no join can drop or multiply a row.  ``change`` is
    ``after - before``, and ``ties`` says whether the causes add up to it.
    """
    def side(df: DataFrame, later: bool) -> DataFrame:
        return df.select(*keys, F.lit(later).alias("__later"), period.alias("__p"), F.xxhash64(category).alias("__c"), amount.alias("__m"), F.coalesce(counts, F.lit(False)).alias("__k"))

    both = side(before, False).unionByName(side(after, True))
    of = lambda later, c: F.when(F.col("__later") == F.lit(later), F.col(c))
    zero = lambda c: F.coalesce(c, F.lit(0))
    parts = {}
    for name, later in (("b", False), ("a", True)):
        parts |= {
            f"{name}_n": F.count_if(F.col("__later") == F.lit(later)), f"{name}_p": F.min(of(later, "__p")), f"{name}_c": F.min(of(later, "__c")),
            f"{name}_m": zero(F.sum(of(later, "__m"))), f"{name}_k": F.bool_or(of(later, "__k")),
        }
    rows = both.groupBy(*keys).agg(*[c.alias(n) for n, c in parts.items()])
    old, new, was, is_ = F.col("b_m"), F.col("a_m"), F.col("b_k"), F.col("a_k")
    counted = lambda flag, value: F.when(flag, value).otherwise(F.lit(0))
    gone, come = F.col("a_n") == 0, F.col("b_n") == 0
    moved = ~F.col("a_p").eqNullSafe(F.col("b_p"))
    line = lambda name, p, value: F.struct(p.alias("period"), F.lit(name).alias("cause"), value.cast("decimal(28,4)").alias("value"))
    lines = F.when(come, F.array(line("arrived", F.col("a_p"), counted(is_, new)))).when(gone, F.array(line("withdrawn", F.col("b_p"), -counted(was, old)))).otherwise(F.array(
        line("moved", F.col("b_p"), F.when(moved, -counted(was, old)).otherwise(F.lit(0))),
        line("moved", F.col("a_p"), F.when(moved, counted(was, old)).otherwise(F.lit(0))),
        line("reclassified", F.col("a_p"), F.when(~F.col("a_c").eqNullSafe(F.col("b_c")), counted(is_, old) - counted(was, old)).otherwise(F.lit(0))),
        line("corrected", F.col("a_p"), F.when(F.col("a_c").eqNullSafe(F.col("b_c")), counted(is_, new) - counted(was, old)).otherwise(counted(is_, new) - counted(is_, old))),
    ))
    held = F.array_compact(F.array(
        F.when(~gone, line("after", F.col("a_p"), counted(is_, new))), F.when(~come, line("before", F.col("b_p"), counted(was, old))),
    ))
    every = rows.select(F.explode(F.concat(lines, held)).alias("l")).select("l.*")
    late = F.coalesce(F.col("period") <= closed_through, F.lit(False))
    every = every.withColumn("cause", F.when((F.col("cause") == "arrived") & late, "late").when(F.col("cause") == "arrived", "new").otherwise(F.col("cause")))
    total = lambda name: zero(F.sum(F.when(F.col("cause") == name, F.col("value")))).alias(name)
    number = lambda name: F.count_if((F.col("cause") == name) & (F.col("value") != 0)).alias(f"n_{name}")
    causes = ["late", "new", "corrected", "reclassified", "moved", "withdrawn"]
    out = every.groupBy("period").agg(total("before"), *[total(c) for c in causes], total("after"), *[number(c) for c in causes])
    change = F.col("after") - F.col("before")
    return out.withColumns({"change": change, "ties": change == sum((F.col(c) for c in causes[1:]), F.col(causes[0]))})

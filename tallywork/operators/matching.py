"""Line-level match of two ledgers: same key and amount, days a few apart, one line with one line."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Parts into which the lines of one key, amount and day are dealt to be numbered.
PARTS = 256
_GROUP = ("key", "amount", "day")


def _part() -> Column:
    return F.coalesce(F.substring(F.md5(F.col("line_id").cast("string")), 1, 2), F.lit(""))


def _dealt(lines: DataFrame) -> DataFrame:
    """``lines`` with ``part`` (two hex digits of the id's MD5), dealt by it and their group.

    Lines, their parts and their groups are all read from this one exchange, so the ledger beneath is read once.
    """
    return lines.withColumn("part", _part()).repartition(*_GROUP, "part")


def _size() -> Column:
    """Number of rows; it names the id, so that an exchange that is counted has the columns of one that is not, and is the same one."""
    return F.count("line_id") + F.count_if(F.col("line_id").isNull())


def numbered(lines: DataFrame) -> DataFrame:
    """``lines`` with ``place``: 0, 1, ... within key, amount and day, by part (two hex digits of the id's MD5) and id.  A line without id has none."""
    return _numbered(_dealt(lines)).where("line_id IS NOT NULL")


def _numbered(dealt: DataFrame, of_group: DataFrame | None = None) -> DataFrame:
    """Dealt lines with their ``place``, and what ``of_group`` says of their group.

    Windows hold one part of a group; the parts' offsets come from a table of counts with at most ``PARTS`` rows a group.
    """
    counts = dealt.groupBy(*_GROUP, "part").agg(_size().alias("n"))
    before = F.sum("n").over(W.partitionBy(*_GROUP).orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.withColumn("offset", F.coalesce(before, F.lit(0))).drop("n")
    if of_group is not None:
        offsets = offsets.join(of_group, [*_GROUP])
    own = F.row_number().over(W.partitionBy(*_GROUP, "part").orderBy("line_id")) - 1
    return dealt.withColumn("own", own).join(offsets, [*_GROUP, "part"]).withColumn("place", F.col("own") + F.col("offset")).drop("part", "own", "offset")


def _assigned(days: int):
    """Ranges of places of days that match: of two days with lines to spare the nearest first, then the earlier right day."""
    gaps = [s * d for d in range(1, days + 1) for s in (-1, 1)]

    def one(group: pd.DataFrame) -> Iterator[tuple]:
        used = {c: dict(zip(group["n_day"], group["same"], strict=True)) for c in ("left", "right")}
        have = {c: dict(zip(group["n_day"], group[f"n_{c}"], strict=True)) for c in ("left", "right")}
        for gap in gaps:
            # The pairs of days of one gap have no day of a side in common, so their order makes no difference.
            for day in have["left"]:
                other = day + gap
                if other in have["right"]:
                    m = min(have["left"][day] - used["left"][day], have["right"][other] - used["right"][other])
                    if m > 0:
                        yield day, other, used["left"][day], used["right"][other], m
                        used["left"][day] += m
                        used["right"][other] += m

    def run(groups: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (key, amount), group in groups.groupby(["key", "amount"], sort=False):
            out += [(key, amount, *found) for found in one(group)]
        return pd.DataFrame(out, columns=["key", "amount", "n_day", "n_other", "left_from", "right_from", "m"])

    return run


def _text(column: str) -> Column:
    """Keys and amounts are assigned as text, which is equal where they are.  It is never NULL, so no filter of a join on it reaches below ``_dealt``."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _moves(counts: DataFrame, days: int) -> DataFrame:
    """``key, amount, n_day, n_other, left_from, right_from, m``: places of a left day that match places of another right day."""
    text = counts.select(_text("key").alias("key"), _text("amount").alias("amount"), F.unix_date("day").alias("n_day"), "n_left", "n_right", "same")
    # Only keys and amounts with lines to spare on both sides go on; their days are as many as the calendar has.
    spare = text.groupBy("key", "amount").agg(F.sum(F.col("n_left") - F.col("same")).alias("l"), F.sum(F.col("n_right") - F.col("same")).alias("r")).where("l > 0 AND r > 0")
    left_over = text.join(spare.select("key", "amount"), ["key", "amount"], "left_semi").where("n_left > same OR n_right > same")
    tasks = 4 * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = left_over.withColumn("task", F.pmod(F.xxhash64("key", "amount"), F.lit(tasks)))
    schema = "key string, amount string, n_day int, n_other int, left_from long, right_from long, m long"
    return dealt.groupBy("task").applyInPandas(_assigned(days), schema)


def _right_groups(counts: DataFrame, days: int) -> DataFrame:
    """``key, amount, day, same, moves``: how many right lines of a group match on their day, and the ranges that match on another one."""
    moved = _moves(counts, days).groupBy(F.col("key").alias("t_key"), F.col("amount").alias("t_amount"), F.col("n_other").alias("t_day"))
    moved = moved.agg(F.collect_list(F.struct("right_from", "m", "n_day", "left_from")).alias("moves"))  # at most two per day of reach
    on = (_text("key") == F.col("t_key")) & (_text("amount") == F.col("t_amount")) & (F.unix_date("day") == F.col("t_day"))
    return counts.join(moved, on, "left").select(*_GROUP, "same", "moves")


def _paired(left: DataFrame, right: DataFrame, days: int) -> DataFrame:
    """``side, line_id, key, amount, day, matched_id, day_gap`` of every line of two ledgers without NULL key, amount or day.

    A left line stands at its own day and place, a right line at those of the left line it matches, or below zero if there is none; a
    line without id matches none.  So one full join by key, amount, day and place finds all partners and keeps all others.
    """
    dealt = {"left": _dealt(left), "right": _dealt(right)}
    own = {name: df.groupBy(*_GROUP).agg(_size().alias("n")) for name, df in dealt.items()}
    number = lambda name: F.sum(F.when(F.col("from") == name, F.col("n")).otherwise(0)).alias(f"n_{name}")
    counts = own["left"].withColumn("from", F.lit("left")).unionByName(own["right"].withColumn("from", F.lit("right")))
    counts = counts.groupBy(*_GROUP).agg(number("left"), number("right")).withColumn("same", F.least("n_left", "n_right"))

    place, same = F.col("place"), F.col("place") < F.col("same")
    nowhere = -1 - place
    known = F.col("line_id").isNotNull()
    lefts = _numbered(dealt["left"]).select("key", "amount", F.unix_date("day").alias("n_day"), F.when(known, place).otherwise(nowhere).alias("place"), F.col("line_id").alias("l_id"), F.lit(True).alias("l"))
    rights = _numbered(dealt["right"], _right_groups(counts, days))
    found = F.get(F.filter("moves", lambda x: (x.right_from <= place) & (place < x.right_from + x.m)), F.lit(0))
    rights = rights.withColumn("move", F.when(~same, found))
    rights = rights.select(
        "key", "amount", F.when(same, F.unix_date("day")).otherwise(F.coalesce("move.n_day", F.unix_date("day"))).alias("n_day"),
        F.when(~known, nowhere).when(same, place).otherwise(F.coalesce(place - F.col("move.right_from") + F.col("move.left_from"), nowhere)).alias("place"),
        F.col("line_id").alias("r_id"), F.col("day").alias("r_day"), F.lit(True).alias("r"),
    )
    both = lefts.join(rights, ["key", "amount", "n_day", "place"], "full")
    gap = F.when(F.col("l") & F.col("r"), F.unix_date("r_day") - F.col("n_day"))
    row = lambda side, line, day, other: F.struct(F.lit(side).alias("side"), F.col(line).alias("line_id"), day.alias("day"), F.col(other).alias("matched_id"))
    rows = F.array_compact(F.array(
        F.when(F.col("l"), row("left", "l_id", F.date_from_unix_date("n_day"), "r_id")), F.when(F.col("r"), row("right", "r_id", F.col("r_day"), "l_id")),
    ))
    lines = both.select("key", "amount", gap.alias("day_gap"), F.explode(rows).alias("x"))
    return lines.select("x.side", "x.line_id", "key", "amount", "x.day", "x.matched_id", "day_gap")


def match_lines(left: DataFrame, right: DataFrame, days: int) -> DataFrame:
    """``side, line_id, key, amount, day, matched_id, day_gap, match_class`` of every line of two ledgers.

    Both sides have ``line_id`` (unique within a side), ``key, amount, day``.  Two lines can match if key and amount are equal and their days at most ``days``
    apart.  Among equal keys and amounts the nearest days are matched first, of two as near the earlier right day; within a day
    lines match in the order of ``numbered``.  That is the assignment in which no two lines would both rather have each other, and each line
    has one partner at most.

    Leftovers are ``other_amount`` where the other side has a leftover of the key within the days, ``other_day`` where it has one of
    the key and amount outside of them, else ``missing``.  A line with a NULL key, amount or day is ``incomplete`` and matches none.

    Lines are counted per key, amount and day before anything is compared, so many lines of one key and amount make no pairs: days are
    assigned on the counts, in bounded groups, and lines find their partner by place, over equal keys of joins that Spark can split.
    """
    kinds = left.schema
    same_type = lambda df: df.select("line_id", F.col("key").cast(kinds["key"].dataType), F.col("amount").cast(kinds["amount"].dataType), F.col("day").cast("date"))
    complete = F.col("key").isNotNull() & F.col("amount").isNotNull() & F.col("day").isNotNull()
    sides = {"left": same_type(left), "right": same_type(right)}
    every = _paired(sides["left"].where(complete), sides["right"].where(complete), days)
    for name, df in sides.items():
        rest = df.where(~complete).select(F.lit(name).alias("side"), *df.columns)
        every = every.unionByName(rest, allowMissingColumns=True)
    # Rows that repeat an id share their partners; otherwise there is one at most.  All that follows reads this one exchange.
    partners = F.collect_list(F.when(F.col("day_gap").isNotNull(), F.struct("matched_id", "day_gap"))).over(W.partitionBy("side", "line_id"))
    lines = every.withColumn("partners", partners).drop("matched_id", "day_gap")
    alone = F.size("partners") == 0

    # What is left over is joined by itself, whatever its side, to the other side's leftovers; both read the exchange of all its columns.
    spare = lines.where(alone & complete).drop("partners").repartition("side", *_GROUP, "line_id")
    groups = spare.select(F.when(F.col("side") == "left", "right").otherwise("left").alias("side"), *_GROUP)
    reach = F.explode(F.sequence(F.date_sub("day", days), F.date_add("day", days)))
    near = groups.select("side", "key", "day").distinct().select("side", "key", reach.alias("day")).distinct().withColumn("near", F.lit(True))
    far = groups.select("side", "key", "amount").distinct().withColumn("far", F.lit(True))
    left_over = spare.join(near, ["side", "key", "day"], "left").join(far, ["side", "key", "amount"], "left")
    kind = F.when(F.col("near"), "other_amount").when(F.col("far"), "other_day").otherwise("missing")
    left_over = left_over.withColumn("match_class", kind).drop("near", "far")

    met = lines.where(~(alone & complete)).select("side", "line_id", *_GROUP, F.explode_outer("partners").alias("p"))
    gap = F.col("p.day_gap")
    met = met.select("side", "line_id", *_GROUP, "p.matched_id", gap.alias("day_gap"), F.when(gap == 0, "same_day").when(gap.isNotNull(), "near_day").otherwise("incomplete").alias("match_class"))
    return met.unionByName(left_over, allowMissingColumns=True)


def match_summary(matched: DataFrame) -> DataFrame:
    """Lines and amounts of either side by class: a difference in total is spread over what does not match."""
    return matched.groupBy("side", "match_class").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("amount").alias("amount"))

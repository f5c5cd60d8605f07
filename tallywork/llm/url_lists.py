"""URL filters by a temporal list join, in DataFrame operations only.

Entries of block and allow lists are dated: from a day on a key is listed with an action, until the key's next entry.  That
gives validity intervals.  A capture is judged by the entries that were active on the day it was fetched, not by today's list,
through an as-of join of its day with the intervals of its keys: the whole URL without query, its host, and every parent domain.
The most specific active entry decides.

As lists are dated by day, captures and entries are reduced to one row per key and day before they meet.  A host with a third
of all captures then has as many rows as there are days, and the verdicts go back to the captures over a plain join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.shared import written

#: Actions that an entry can have; "drop" takes a key off the list.  Of entries of one key and day the first here wins.
ACTIONS = ("block", "allow", "drop")
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host of a URL, without user, port and final dot; empty where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _AUTHORITY, 1)), r"\.+$", "")


def keys(url: Column) -> Column:
    """Keys that can list a URL, most specific first: host with path, then the host and its parent domains of two labels or more."""
    name = host(url)
    path = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1), "/+$", "")
    labels = F.split(name, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 1)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    every = F.when(path == "", domains).otherwise(F.concat(F.array(F.concat(name, path)), domains))
    return F.when(name == "", F.array().cast("array<string>")).otherwise(every)


def intervals(entries: DataFrame) -> DataFrame:
    """``key, action, valid_from, valid_to`` of dated ``key, action, listed_on`` rows; the last of a key is open (NULL).

    Rows without key, day or a known action are ignored.  Of several entries of a key and day the strictest holds; an entry that
    repeats the action before it opens no new interval.
    """
    rank = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action"))
    day = entries.where(F.col("key").isNotNull() & F.col("listed_on").isNotNull() & F.col("action").isin(*ACTIONS))
    day = day.groupBy("key", F.col("listed_on").cast("date").alias("valid_from")).agg(F.min_by("action", rank).alias("action"))
    by_key = Window.partitionBy("key").orderBy("valid_from")
    changed = day.withColumn("before", F.lag("action").over(by_key)).where(~F.col("action").eqNullSafe(F.col("before"))).drop("before")
    return changed.select("key", "action", "valid_from", F.lead("valid_from").over(by_key).alias("valid_to"))


def _active(days: DataFrame, spans: DataFrame) -> DataFrame:
    """``key, day, action, since`` of the entry active on each day: the last one that began by then.

    Both sides have one row per key and day at most, so a key's window is as long as the calendar.
    """
    marks = spans.select("key", F.col("valid_from").alias("day"), F.struct("action", F.col("valid_from").alias("since")).alias("mark"))
    asked = days.select("key", "day", F.lit(None).cast("struct<action:string,since:date>").alias("mark"))
    # Marks come before the captures of their day: an entry holds on the day it is dated.
    order = Window.partitionBy("key").orderBy("day", F.col("mark").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = marks.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    held = both.withColumn("last", F.last("mark", ignorenulls=True).over(order)).where("asks")
    return held.select("key", "day", F.col("last.action").alias("action"), F.col("last.since").alias("since")).where("action <> 'drop'")


def judge(captures: DataFrame, entries: DataFrame, id: str = "page_id", url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """``page_id, host, fetched_on, verdict, list_key, active_since`` of every capture.

    The verdict is the action of the most specific entry active on the day of the fetch, "none" without one.  Captures without
    URL, host or day get "none".  Rows that repeat an id are judged one by one; other columns take no part.
    """
    made = captures.select(F.col(id).alias("page_id"), F.col(url).alias("url"), F.col(fetched).cast("date").alias("fetched_on"))
    made = made.select("page_id", host(F.col("url")).alias("host"), "fetched_on", keys(F.col("url")).alias("keys"), F.monotonically_increasing_id().alias("row"))
    held = written(made, "captures")
    spans = written(intervals(entries), "intervals")
    asked = held.where("fetched_on IS NOT NULL").select("row", F.col("fetched_on").alias("day"), F.posexplode("keys").alias("rank", "key"))
    # A host's rows are reduced to days in an exchange by key and day of their own; a semi-join would go below it, to an exchange by key.
    days = asked.select("key", "day").distinct().join(spans.select("key").distinct(), "key")
    active = _active(days, spans)
    best = asked.join(active, ["key", "day"]).groupBy("row").agg(F.min_by(F.struct("action", "key", "since"), "rank").alias("hit"))
    return held.join(best, "row", "left").select(
        "page_id", "host", "fetched_on", F.coalesce("hit.action", F.lit("none")).alias("verdict"), F.col("hit.key").alias("list_key"), F.col("hit.since").alias("active_since"),
    )

"""FX by date: the rate of the day, or the last known one when the day has none."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallywork.operators.rollup import with_boundary

BASE_RATE = Decimal("1.0")


def daily_rates(rates: DataFrame, horizon: DataFrame) -> DataFrame:
    """Dense table (currency, rate_date, rate, quoted_on): one row per currency and calendar day.

    Of several quotes for one currency and day the highest counts; ``horizon`` is the one-value
    aggregate with the day up to which the latest quotes stay valid.  Its size is currencies
    times days whatever the size of the facts, and the windows below see quotes only.
    """
    until = F.lead("rate_date").over(W.partitionBy("currency").orderBy("rate_date", "rate"))
    last_of_day = F.col("__next").isNull() | (F.col("__next") > F.col("rate_date"))
    quoted = with_boundary(rates.withColumn("__next", until).where(last_of_day), "last_day", horizon)
    last_valid = F.coalesce(F.date_sub("__next", 1), F.greatest(F.col("last_day"), F.col("rate_date")))
    return quoted.select(
        "currency",
        F.explode(F.sequence(F.col("rate_date"), last_valid)).alias("valid_on"),
        "rate",
        F.col("rate_date").alias("quoted_on"),
    ).withColumnRenamed("valid_on", "rate_date")


def known_rates(quotes: DataFrame, as_of: Column) -> DataFrame:
    """``currency, rate_date, rate`` as they were known on a day: the last quote of each date that had arrived by then.

    ``quotes`` carry ``known_on`` next to ``rate_date``: a rate that is corrected or filled in later is another row for its date.  Of
    quotes that arrived on one day for one date the highest counts.
    """
    known = quotes.where(F.col("known_on") <= as_of)
    return known.groupBy("currency", "rate_date").agg(F.max(F.struct("known_on", "rate")).alias("__q")).select("currency", "rate_date", "__q.rate")


def rate_as_known(facts: DataFrame, quotes: DataFrame, currency: str, ts: str, as_of: Column, base: str = "USD") -> DataFrame:
    """``rate_as_of`` on two axes: valid on the day of the fact, known on ``as_of``.

    A close that is run again with its own ``as_of`` gives its own numbers, whatever has been corrected since.
    """
    return rate_as_of(facts, known_rates(quotes, as_of), currency, ts, base)


def rate_as_of(facts: DataFrame, rates: DataFrame, currency: str, ts: str, base: str = "USD") -> DataFrame:
    """Add ``fx_rate_to_usd`` and ``quoted_on``; NULL before the first quote of a currency.

    An equi-join on currency and day: a currency that holds most of the facts is spread
    over its days, and Spark broadcasts the rates when they are small enough.
    """
    horizon = facts.agg(F.max(F.col(ts).cast("date")))
    dense = daily_rates(rates, horizon).select(
        F.col("currency").alias("__ccy"), F.col("rate_date").alias("__day"), F.col("rate").alias("__rate"), "quoted_on"
    )
    on = (F.col(currency) == F.col("__ccy")) & (F.col(ts).cast("date") == F.col("__day"))
    priced = facts.join(dense, on, "left")
    rate = F.when(F.col(currency) == base, F.lit(BASE_RATE)).otherwise(F.col("__rate"))
    return priced.withColumn("fx_rate_to_usd", rate).drop("__ccy", "__day", "__rate")

"""Replayed and late usage records on a stream.

A watermark needs an event time with a zone, so ``timestamp_ntz`` columns are cast, and daily
windows start at midnight UTC: run the session in UTC, as ``SETTINGS`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", **options) -> DataFrame:
    """File stream over a folder that keeps receiving files; ``pattern`` selects the feed."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.options(**options).parquet(folder)


def _zoned(usage: DataFrame, event_time: str) -> DataFrame:
    return usage.withColumn(event_time, F.col(event_time).cast("timestamp"))


def replay_dedup(usage: DataFrame, key: Sequence[str], event_time: str, watermark: str = "1 day") -> DataFrame:
    """First arrival per business key within the watermark; state is dropped behind it."""
    return _zoned(usage, event_time).withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(key))


def daily_usage(usage: DataFrame, event_time: str, kind: str, units: str, watermark: str = "1 day") -> DataFrame:
    """Events and units per day and type; a day is final once the watermark has passed it."""
    return (
        _zoned(usage, event_time).withWatermark(event_time, watermark)
        .groupBy(F.window(event_time, "1 day").alias("day"), F.col(kind).alias("usage_type"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum(units).alias("units"))
        .select(F.col("day.start").cast("timestamp_ntz").alias("usage_day"), "usage_type", "events", "units")
    )


def with_end(stream: DataFrame, event_time: str, folder: str, at: str) -> DataFrame:
    """The stream and one more row, NULL but for its event time ``at``, so that a bounded run closes every earlier day.

    The row is a file in ``folder``, read as a stream of its own next to the other; choose an instant later than any event by
    more than the watermark and a day.  Its own day stays open, so it is never in a result.
    """
    spark = stream.sparkSession
    end = spark.range(1).select(*[
        (F.lit(at).cast(f.dataType) if f.name == event_time else F.lit(None).cast(f.dataType)).alias(f.name) for f in stream.schema.fields
    ])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema.fields])
    end.coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/end")
    return stream.unionByName(spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/end"))


def run_available(stream: DataFrame, folder: str) -> DataFrame:
    """Process what has arrived since the last run into a Parquet sink below ``folder``, then read the whole sink.

    Sink and checkpoint lie in ``folder``, which the caller names and all executors share: the next run with the same folder
    resumes from its offsets and state, reads new files only, and every file is committed exactly once.  Set
    ``maxFilesPerTrigger`` on the stream to bound its batches.
    """
    folder = folder.rstrip("/")
    query = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/data")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/data")

"""Streams that lose nothing: every arrival is counted, and the best row of a key survives any order of arrival.

A watermark would drop what arrives behind it.  Here each micro-batch is reduced to one row per key and written under the batch's own
number; a batch that Spark runs again after a failure writes the same folder again, so every arrival counts once.  What a key's
rows in several batches leave is decided when the folder is read, by one aggregation, and ``compact`` folds finished batches into one.
So a batch costs what it holds, whatever has arrived before, and no state is kept in memory.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_COUNTS = "batch long, n_input long, n_kept long, n_replay long, n_late long"


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _listed(spark: SparkSession, folder: str) -> list[int]:
    fs, target = _path(spark, folder)
    if not fs.exists(target):
        return []
    done = [s.getPath() for s in fs.listStatus(target)]
    return sorted(int(p.getName().removeprefix("batch=")) for p in done if p.getName().startswith("batch=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _best(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> list[Column]:
    """The first row of a group by ``order``, then by all other columns, whatever order they come in."""
    rest = [c for c in df.columns if c not in (*key, *order) and not c.startswith("__")]
    return [F.min(F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(c) for c in (*order, *rest)])).alias("__row")]


def _flat(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in key else F.col(f"__row.{c}.v").alias(c) for c in columns], *[c for c in df.columns if c.startswith("__") and c != "__row"])


def collect_arrivals(stream: DataFrame, folder: str, key: Sequence[str], order: Sequence[str], event_time: str, delay: str = "1 day") -> None:
    """Process what has arrived since the last run into ``folder``, which the caller names and all executors share.

    A row is late if its ``event_time`` lies more than ``delay`` before the latest one of all earlier batches; it is kept like any
    other, and counted.  Rows without event time are never late.  ``key`` is NULL-safe.
    """
    folder, columns = folder.rstrip("/"), stream.columns

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = _parts(spark, folder, number)
        border = None
        if seen:
            latest = reduce(DataFrame.unionByName, [df.select("__latest") for df in seen])
            border = latest.agg(F.max("__latest") - F.expr(f"INTERVAL {delay}")).first()[0]
        late = F.col(event_time) < F.lit(border) if border is not None else F.lit(False)
        each = batch.withColumn("__late", F.coalesce(late, F.lit(False)))
        each = each.groupBy(*key).agg(
            *_best(each, key, order), F.count(F.lit(1)).alias("__n"), F.count_if("__late").alias("__n_late"), F.max(F.col(event_time).cast("timestamp_ntz")).alias("__latest"),
        )
        _flat(each, key, columns).write.mode("overwrite").parquet(f"{folder}/arrived/batch={number}")

    query = stream.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint").start()
    query.awaitTermination()


def _parts(spark: SparkSession, folder: str, before: int) -> list[DataFrame]:
    """The last base and the batches after it, up to a number."""
    bases = [n for n in _listed(spark, f"{folder}/base") if n < before]
    last = bases[-1] if bases else -1
    parts = [spark.read.parquet(f"{folder}/arrived/batch={n}").withColumn("__batch", F.lit(n).cast("long")) for n in _listed(spark, f"{folder}/arrived") if last < n < before]
    return ([spark.read.parquet(f"{folder}/base/batch={last}")] if bases else []) + parts


def _arrived(spark: SparkSession, folder: str) -> DataFrame:
    """One row per key and batch, compacted batches as one."""
    folder = folder.rstrip("/")
    parts = _parts(spark, folder, 1 << 62)
    if not parts:
        raise FileNotFoundError(f"nothing has arrived in {folder}")
    return reduce(DataFrame.unionByName, parts)


def kept_rows(spark: SparkSession, folder: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key by ``order``, of all that has ever arrived."""
    rows = _arrived(spark, folder)
    columns = [c for c in rows.columns if not c.startswith("__")]
    return _flat(rows.groupBy(*key).agg(*_best(rows, key, order)), key, columns).select(*columns)


def arrival_counts(spark: SparkSession, folder: str, key: Sequence[str]) -> DataFrame:
    """``batch, n_input, n_kept, n_replay, n_late``: rows of each batch, keys first seen in it, other rows, and rows behind the border.

    Kept and replayed rows add up to the input, of every batch and in total; late rows are among them.
    """
    rows = _arrived(spark, folder)
    first = rows.groupBy(*key).agg(F.min("__batch").alias("__first"))
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(first[k]) for k in key])
    joined = rows.join(first, same).select(rows["__batch"], rows["__n"], rows["__n_late"], first["__first"])
    kept = F.count_if(F.col("__batch") == F.col("__first"))
    out = joined.groupBy(F.col("__batch").alias("batch")).agg(F.sum("__n").alias("n_input"), kept.alias("n_kept"), (F.sum("__n") - kept).alias("n_replay"), F.sum("__n_late").alias("n_late"))
    counts = _base_counts(spark, folder)
    return out if counts is None else out.join(counts.select("batch"), "batch", "left_anti").unionByName(counts)


def _base_counts(spark: SparkSession, folder: str) -> DataFrame | None:
    bases = _listed(spark, f"{folder.rstrip('/')}/base")
    if not bases:
        return None
    fs, path = _path(spark, f"{folder.rstrip('/')}/base/batch={bases[-1]}/_counts.json")
    stream = fs.open(path)
    try:
        rows = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return spark.createDataFrame([tuple(r) for r in rows], _COUNTS)


def compact(spark: SparkSession, folder: str, key: Sequence[str], order: Sequence[str]) -> None:
    """Fold all finished batches into one base, with their counts; the batches' own folders can then be removed.

    The base is written under the last batch's number, so a reader sees either all of it or the batches.
    """
    folder = folder.rstrip("/")
    rows = _arrived(spark, folder)
    columns = [c for c in rows.columns if not c.startswith("__")]
    counts = [tuple(r) for r in arrival_counts(spark, folder, key).orderBy("batch").collect()]  # a row a batch
    last = max(c[0] for c in counts)
    best = rows.groupBy(*key).agg(*_best(rows, key, order), F.sum("__n").alias("__n"), F.sum("__n_late").alias("__n_late"), F.max("__latest").alias("__latest"), F.min("__batch").alias("__batch"))
    staged = f"{folder}/base/.{last}"
    _flat(best, key, columns).write.mode("overwrite").parquet(staged)
    fs, path = _path(spark, f"{staged}/_counts.json")
    stream = fs.create(path, True)
    stream.write(bytearray(json.dumps(counts), "utf-8"))
    stream.close()
    _, target = _path(spark, f"{folder}/base/batch={last}")
    if not fs.exists(target):
        fs.rename(_path(spark, staged)[1], target)

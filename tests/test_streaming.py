from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F, types as T

from conftest import at, rows_of
from tallywork.streaming import (
    arrival_counts, collect_arrivals, compact, daily_usage, kept_rows, read_stream, replay_dedup, run_available, unmatched_within, with_end,
)

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("line", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("units", T.DecimalType(14, 3)), T.StructField("ts", T.TimestampNTZType()),
])


def _arrive(spark, folder, batches):
    """One file per batch, in arrival order."""
    for i, rows in enumerate(batches):
        part = spark.createDataFrame([(a, b, c, Decimal(d), at(t)) for a, b, c, d, t in rows], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/{i}")


def _stream(spark, folder):
    files = read_stream(spark, f"{folder}/[0-9]", SCHEMA, maxFilesPerTrigger=1)
    return files.withColumn("day", F.col("ts").cast("date"))


def test_replays_across_batches_count_once(spark, tmp_path):
    _arrive(spark, tmp_path, [
        [(1, 7, "data", "1.000", "2024-01-01 10:00"), (2, 7, "data", "1.000", "2024-01-01 11:00")],
        [(3, 7, "data", "1.000", "2024-01-01 12:00"), (4, 7, "data", "2.000", "2024-01-01 12:00")],
        [(5, 7, "data", "1.000", "2024-01-02 09:00")],
    ])
    kept = replay_dedup(_stream(spark, tmp_path), ["line", "day", "kind", "units"], "ts", "1 day")
    assert rows_of(run_available(kept.select("line", "day", "units"), f"{tmp_path}/out"), "units") == [(Decimal("1.000"),), (Decimal("1.000"),), (Decimal("2.000"),)]


def test_late_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    _arrive(spark, tmp_path, [
        [(1, 7, "data", "1.000", "2024-01-01 10:00"), (2, 7, "data", "2.000", "2024-01-01 23:00")],
        [(3, 7, "data", "5.000", "2024-01-05 10:00")],
        [(4, 7, "data", "1.000", "2024-01-05 11:00")],   # late rows are judged by the watermark of the batch before
        [(5, 7, "data", "9.000", "2024-01-01 12:00")],   # arrives after the watermark passed its day
        [(6, 7, "data", "1.000", "2024-01-09 10:00")],
    ])
    out = run_available(daily_usage(_stream(spark, tmp_path), "ts", "kind", "units"), f"{tmp_path}/out")
    assert rows_of(out, "usage_day", "usage_type", "events", "units") == [
        (at("2024-01-01"), "data", 2, Decimal("3.000")), (at("2024-01-05"), "data", 2, Decimal("6.000")),
    ]


def test_a_restarted_run_reads_only_new_files(spark, tmp_path):
    """State and offsets are in the named folder: replays of an earlier run's rows are known, its files are not read again."""
    _arrive(spark, tmp_path, [[(1, 7, "data", "1.000", "2024-01-01 10:00")], [(2, 7, "data", "2.000", "2024-01-01 11:00")]])
    dedup = lambda: replay_dedup(_stream(spark, tmp_path), ["line", "day", "kind", "units"], "ts").select("id", "units")
    assert rows_of(run_available(dedup(), f"{tmp_path}/out"), "id") == [(1,), (2,)]
    assert rows_of(run_available(dedup(), f"{tmp_path}/out"), "id") == [(1,), (2,)]
    part = spark.createDataFrame([(3, 7, "data", Decimal("1.000"), at("2024-01-01 10:30")), (4, 8, "data", Decimal("1.000"), at("2024-01-01 10:30"))], SCHEMA)
    part.coalesce(1).write.parquet(f"{tmp_path}/2")
    assert rows_of(run_available(dedup(), f"{tmp_path}/out"), "id") == [(1,), (2,), (4,)]


def test_an_end_mark_closes_every_day(spark, tmp_path):
    _arrive(spark, tmp_path, [[(1, 7, "data", "1.000", "2024-01-01 10:00")], [(2, 7, "data", "2.000", "2024-01-02 23:00")]])
    usage = with_end(_stream(spark, tmp_path), "ts", f"{tmp_path}/out", "2100-01-01 00:00:00")
    out = run_available(daily_usage(usage, "ts", "kind", "units"), f"{tmp_path}/out")
    assert rows_of(out, "usage_day", "events") == [(at("2024-01-01"), 1), (at("2024-01-02"), 1)]


KEY = ["line", "day", "kind", "units"]
BATCHES = [
    [(5, 7, "data", "1.000", "2024-01-05 10:00"), (6, 7, "data", "1.000", "2024-01-05 11:00"), (7, None, "data", "1.000", "2024-01-05 12:00")],
    [(3, 7, "data", "1.000", "2024-01-05 09:00"), (8, 8, "sms", "2.000", "2024-01-09 12:00")],
    [(1, 9, "data", "4.000", "2024-01-01 10:00"), (2, 7, "data", "1.000", "2024-01-05 23:00"), (9, None, "data", "1.000", "2024-01-05 12:00")],
]


def _collect(spark, folder, source=None):
    stream = read_stream(spark, f"{source or folder}/[0-9]", SCHEMA, maxFilesPerTrigger=1).withColumn("day", F.col("ts").cast("date"))
    collect_arrivals(stream, f"{folder}/out", KEY, ["id"], "ts")


def test_nothing_that_arrives_is_lost(spark, tmp_path):
    """The lowest id of each key survives any order of arrival; kept and replayed rows are the input, late ones among them."""
    _arrive(spark, tmp_path, BATCHES)
    _collect(spark, tmp_path)
    out = f"{tmp_path}/out"
    assert rows_of(kept_rows(spark, out, KEY, ["id"]), "id") == [(1,), (2,), (7,), (8,)]
    assert rows_of(arrival_counts(spark, out, KEY)) == [(0, 3, 2, 1, 0), (1, 2, 1, 1, 0), (2, 3, 1, 2, 3)]
    for order in ([2, 1, 0], [1, 0, 2]):
        other = tmp_path / "-".join(map(str, order))
        _arrive(spark, other, [BATCHES[i] for i in order])
        _collect(spark, other)
        assert rows_of(kept_rows(spark, f"{other}/out", KEY, ["id"]), "id") == [(1,), (2,), (7,), (8,)]
        total = arrival_counts(spark, f"{other}/out", KEY).agg(F.sum("n_input"), F.sum("n_kept"), F.sum("n_replay")).first()
        assert tuple(total) == (8, 4, 4)


def test_compacted_batches_count_the_same_and_later_ones_go_on(spark, tmp_path):
    _arrive(spark, tmp_path, BATCHES[:2])
    _collect(spark, tmp_path)
    out = f"{tmp_path}/out"
    compact(spark, out, KEY, ["id"])
    compact(spark, out, KEY, ["id"])
    assert rows_of(arrival_counts(spark, out, KEY)) == [(0, 3, 2, 1, 0), (1, 2, 1, 1, 0)]
    spark.createDataFrame([(a, b, c, Decimal(d), at(t)) for a, b, c, d, t in BATCHES[2]], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/2")
    _collect(spark, tmp_path)
    assert rows_of(kept_rows(spark, out, KEY, ["id"]), "id") == [(1,), (2,), (7,), (8,)]
    assert rows_of(arrival_counts(spark, out, KEY)) == [(0, 3, 2, 1, 0), (1, 2, 1, 1, 0), (2, 3, 1, 2, 3)]


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    """As after a failure between a batch's write and its commit."""
    _arrive(spark, tmp_path, BATCHES)
    _collect(spark, tmp_path)
    (tmp_path / "out/checkpoint/commits/2").unlink()
    for crc in (tmp_path / "out/checkpoint/commits").glob(".2*"):
        crc.unlink()
    _collect(spark, tmp_path)
    assert arrival_counts(spark, f"{tmp_path}/out", KEY).agg(F.sum("n_input")).first()[0] == 8


DUE = T.StructType([T.StructField("trip", T.LongType()), T.StructField("asked", T.TimestampNTZType())])
DONE = T.StructType([T.StructField("trip", T.LongType()), T.StructField("got", T.TimestampNTZType())])


def _unmatched(spark, folder):
    due = with_end(read_stream(spark, f"{folder}/due/[0-9]", DUE, maxFilesPerTrigger=1), "asked", f"{folder}/a", "2100-01-01 00:00:00")
    done = with_end(read_stream(spark, f"{folder}/done/[0-9]", DONE, maxFilesPerTrigger=1), "got", f"{folder}/b", "2100-01-01 00:00:00")
    return due, done


def test_fares_without_capture_come_out_once_their_time_has_passed(spark, tmp_path):
    put = lambda side, i, schema, rows: spark.createDataFrame([(a, at(t)) for a, t in rows], schema).coalesce(1).write.parquet(f"{tmp_path}/{side}/{i}")
    put("due", 0, DUE, [(1, "2024-01-01 10:00"), (2, "2024-01-01 11:00"), (3, "2024-01-02 10:00"), (None, "2024-01-01 10:00")])
    put("done", 0, DONE, [(1, "2024-01-01 12:00"), (3, "2024-01-05 12:00"), (None, "2024-01-01 12:00")])
    open_ = lambda: unmatched_within(read_stream(spark, f"{tmp_path}/due/[0-9]", DUE), read_stream(spark, f"{tmp_path}/done/[0-9]", DONE), "trip", "asked", "got", "1 day", "1 hour")
    first = rows_of(run_available(open_(), f"{tmp_path}/out"), "trip")
    put("due", 1, DUE, [(4, "2024-02-01 10:00")])
    put("done", 1, DONE, [(4, "2024-02-01 10:30")])
    second = rows_of(run_available(open_(), f"{tmp_path}/out"), "trip")      # resumes with the state of the first run
    assert set(first) <= set(second) and sorted(second, key=str) == sorted([(None,), (2,), (3,)], key=str)

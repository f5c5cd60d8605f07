from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of
from tallywork.operators import (
    dedup_business_key, dedup_latest, dedup_priority, first_success_rollup, flag_multi, flag_primary,
    flag_primary_completion, keep_first, with_group_stats,
)

PAYMENT = "payment_id long, order_id long, payment_status string, processed_at timestamp_ntz, amount decimal(12,2)"


def _payments(frame):
    ten = Decimal("10.00")
    return frame(PAYMENT, [
        (1, 1, "failed", None, ten), (2, 1, "failed", None, ten), (3, 1, "succeeded", at("2024-01-01 10:00"), ten),
        (4, 1, "succeeded", at("2024-01-01 10:01"), Decimal("11.00")),
        (5, 2, "failed", None, ten), (6, 3, "succeeded", at("2024-01-02"), ten),
        (8, 4, "succeeded", None, ten), (7, 4, "succeeded", None, ten),
        (9, 5, "succeeded", None, Decimal("2.00")), (10, 5, "succeeded", at("2024-01-05"), Decimal("3.00")),
        (11, None, "succeeded", at("2024-01-06"), ten), (12, None, "succeeded", at("2024-01-07"), ten),
    ])


def _flagged(df):
    return flag_primary(
        df, ["order_id"], "payment_status", "succeeded", ["processed_at", "payment_id"], "n", "is_dup", "is_primary"
    )


def test_first_success_is_primary_and_no_row_is_dropped(frame):
    got = {r.payment_id: (r.n, r.is_dup, r.is_primary) for r in _flagged(_payments(frame)).collect()}
    assert got[1] == got[2] == (2, True, True)      # failures carry the flag of their order
    assert got[3] == (2, True, True) and got[4] == (2, True, False)
    assert got[5] == (0, False, True) and got[6] == (1, False, True)
    assert got[7] == (2, True, True) and got[8] == (2, True, False)    # only NULL times: lowest id
    assert got[9] == (2, True, False) and got[10] == (2, True, True)   # NULL time comes last
    assert got[11] == (2, True, True) and got[12] == (2, True, False)  # NULL keys form one group
    assert len(got) == 12


def test_rollup_equals_sum_of_primary_successes(frame):
    df = _payments(frame)
    rolled = first_success_rollup(
        df, ["order_id"], "payment_status", "succeeded", ["processed_at", "payment_id"],
        measures={"captured": F.col("amount")}, count_col="n",
    )
    kept = F.col("is_primary") & (F.col("payment_status") == "succeeded")
    summed = _flagged(df).groupBy("order_id").agg(
        F.sum(F.when(kept, F.col("amount")).otherwise(0)).alias("captured"), F.max("n").alias("n")
    )
    assert rows_of(rolled, "order_id", "captured", "n") == rows_of(summed, "order_id", "captured", "n")


@pytest.mark.parametrize("seed", [1, 2])
def test_rollup_equals_flags_on_random_feeds(frame, seed):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice([None, *range(12)]), rng.choice(["succeeded", "failed", "other", None]),
         rng.choice([None, at("2024-01-01"), at("2024-01-02")]), rng.choice([None, Decimal("1.50"), Decimal("2.25")]))
        for i in range(150)
    ]
    rng.shuffle(rows)
    df = frame(PAYMENT, rows).repartition(rng.randint(1, 7))
    flagged = _flagged(df)
    kept = F.col("is_primary") & (F.col("payment_status") == "succeeded")
    summed = flagged.groupBy("order_id").agg(
        F.sum(F.when(kept, F.col("amount")).otherwise(0)).alias("captured"), F.max("n").alias("n")
    )
    rolled = first_success_rollup(
        df, ["order_id"], "payment_status", "succeeded", ["processed_at", "payment_id"],
        measures={"captured": F.col("amount")}, count_col="n",
    )
    assert rows_of(rolled, "order_id", "captured", "n") == rows_of(summed, "order_id", "captured", "n")
    # Brute force: exactly one primary success per key that has any.
    expected = {}
    for pid, oid, status, ts, _ in rows:
        if status == "succeeded":
            expected[oid] = min(expected.get(oid, (True, at("9999-01-01"), 10**9)), (ts is None, ts or at("9999-01-01"), pid))
    primaries = {r.order_id: r.payment_id for r in flagged.where(kept).collect()}
    assert primaries == {oid: key[2] for oid, key in expected.items()}


def test_latest_row_is_kept_with_its_count(frame):
    df = frame("driver_id long, onboarded_at timestamp_ntz, city string", [
        (1, at("2023-01-01"), "a"), (1, at("2024-01-01"), "b"), (2, at("2022-01-01"), "c"), (3, at("2022-01-01"), "d"), (3, None, "e"),
    ])
    out = dedup_latest(df, ["driver_id"], ["onboarded_at"], "n", "again")
    assert out.columns == ["driver_id", "onboarded_at", "city", "n", "again"]
    assert rows_of(out) == [
        (1, at("2024-01-01"), "b", 2, True), (2, at("2022-01-01"), "c", 1, False),
        (3, None, "e", 2, True),  # NULL is the largest value, so it is the latest
    ]


def test_latest_does_not_depend_on_partitioning(frame):
    rows = [(k, at("2024-01-01"), f"v{i}") for i, k in enumerate([1, 1, 1, 2, 2])]
    seen = {
        tuple(rows_of(dedup_latest(frame("k long, t timestamp_ntz, v string", r).repartition(n), ["k"], ["t"], "n")))
        for r in (rows, rows[::-1]) for n in (1, 3)
    }
    assert len(seen) == 1


def test_null_order_follows_the_warehouse_rule(frame):
    df = frame("k long, t long", [(1, None), (1, 5), (1, 7)])
    assert keep_first(df, ["k"], [F.col("t").asc_nulls_last()]).first().t == 5
    assert keep_first(df, ["k"], [F.col("t").desc_nulls_first()]).first().t is None


def test_priority_then_recency(frame):
    df = frame("payment_id long, s long, p string, st string, paid timestamp_ntz, due timestamp_ntz", [
        (1, 1, "a", "failed", None, at("2024-01-09")), (2, 1, "a", "paid", at("2024-01-02"), at("2024-01-01")),
        (3, 1, "b", "past_due", None, at("2024-01-01")), (4, 1, "b", "failed", None, at("2024-01-05")),
        (5, 2, "a", "paid", at("2024-01-02"), at("2024-01-01")), (6, 2, "a", "paid", at("2024-01-03"), at("2024-01-01")),
    ])
    out = dedup_priority(df, ["s", "p"], "st", {"paid": 3, "past_due": 2}, [F.coalesce("paid", "due"), "payment_id"], otherwise=1)
    assert sorted(r.payment_id for r in out.collect()) == [2, 3, 6]


def test_replays_keep_the_lowest_id_per_day(frame):
    df = frame("id long, s long, u decimal(14,3), t timestamp_ntz", [
        (9, 1, Decimal("1.000"), at("2024-01-01 01:00")), (3, 1, Decimal("1.000"), at("2024-01-01 22:00")),
        (4, 1, Decimal("1.000"), at("2024-01-02 01:00")), (5, 1, Decimal("1.001"), at("2024-01-01 01:00")),
    ])
    out = dedup_business_key(df, ["s", F.col("t").cast("date"), "u"], ["id"])
    assert sorted(r.id for r in out.collect()) == [3, 4, 5]


LESSON = "e long, n int, id long, lesson_status string, t timestamp_ntz"


def test_primary_completion_default_and_by_status(frame):
    df = frame(LESSON, [
        (1, 1, 1, "started", at("2024-01-01")), (1, 1, 2, "completed", at("2024-01-02")),
        (1, 2, 3, "completed", at("2024-01-02")), (1, 2, 4, "completed", at("2024-01-01")),
        (1, 3, 5, "completed", None),
    ])
    flags = lambda **o: {r.id: r.is_primary_completion for r in flag_primary_completion(df, ["e", "n"], ["t", "id"], **o).collect()}
    assert flags() == {1: True, 2: False, 3: False, 4: True, 5: True}
    assert flags(partition_by_status=True) == {1: True, 2: True, 3: False, 4: True, 5: True}


def test_lines_per_key(frame):
    out = flag_multi(frame("id long, k long", [(1, 1), (2, 1), (3, 2)]), ["k"], "n", "multi")
    assert rows_of(out, "id", "n", "multi") == [(1, 2, True), (2, 2, True), (3, 1, False)]


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A key with a third of the rows must not end in one task of the join that flags rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = spark.range(0, 60000, 1, 12).selectExpr("id", "if(id % 3 = 0, 7, id) AS k", "uuid() AS filler")
        out = with_group_stats(rows, ["k"], {"n": F.count(F.lit(1))})
        result = out.toArrow()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert result.num_rows == 60000
        assert out.where("k = 7").select(F.min("n"), F.max("n")).first() == (20000 + 1, 20000 + 1)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_keep_first_limits_rows_before_the_exchange(frame):
    df = frame("k long, id long", [(1, 1), (1, 2)])
    plan = keep_first(df, ["k"], [F.col("id").asc_nulls_last()])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")

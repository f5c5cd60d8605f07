from __future__ import annotations

import math
import random
from functools import reduce

import pytest

from conftest import rows_of
from tallywork.operators import merge_sketches, sketch, sketch_report
from tallywork.sources.writers import stage_version

QUANTILES = (0.0, 0.1, 0.5, 0.9, 0.999, 1.0)


def _of_rank(values, q):
    return sorted(values)[max(math.ceil(q * len(values)), 1) - 1]


@pytest.mark.parametrize("accuracy", [0.01, 0.1])
def test_quantiles_stay_within_the_accuracy(frame, accuracy):
    draw = random.Random(5)
    values = [draw.choice([-1, 1]) * math.exp(draw.uniform(-30, 30)) for _ in range(3_000)] + [0.0, -0.0, 5e-324, 1.7e308, -1.7e308]
    report = sketch_report(sketch(frame("x double", [(v,) for v in values]), accuracy=accuracy), quantiles=QUANTILES, accuracy=accuracy).first()
    for q in QUANTILES:
        exact, found = _of_rank(values, q), report[f"q{q * 100:g}".replace(".", "_")]
        assert found == 0 if exact == 0 else abs(found - exact) <= abs(exact) * accuracy * (1 + 1e-9) or abs(exact) < 1e-307, q


@pytest.mark.parametrize("n", [1, 50, 2_000, 60_000])
def test_distinct_values_within_four_standard_errors(spark, n):
    df = spark.range(3 * n).selectExpr(f"concat('key-', id % {n}) AS k")
    found = sketch_report(sketch(df)).first()
    assert found.rows == 3 * n and abs(found.distinct_estimate - n) <= max(4 * 1.04 / math.sqrt(2_048) * n, 0)


def test_parts_merge_to_the_whole_in_any_order(spark, tmp_path):
    df = spark.range(4_000).selectExpr("id % 7 AS part", "if(id % 11 = 0, NULL, id * id % 1009) AS a", "CAST(id % 13 AS string) AS b")
    runs = [sketch(df.where(f"part % 3 = {i}"), by=["part"]) for i in range(3)]
    kept = [stage_version(s, str(tmp_path / "sketch"), f"run-{i}") for i, s in enumerate(runs)]
    whole = rows_of(sketch(df, columns=["a", "b"]))
    forward = reduce(lambda x, y: x.unionByName(y), kept)
    backward = reduce(lambda x, y: merge_sketches(y.drop("part").unionByName(x)), [k.drop("part") for k in reversed(kept)])
    assert rows_of(merge_sketches(forward), "column_name", "kind", "bucket", "n") == whole
    assert rows_of(backward, "column_name", "kind", "bucket", "n") == whole
    assert rows_of(merge_sketches(forward, by=["part"])) == rows_of(sketch(df, by=["part"]))
    per_part = sketch_report(forward, by=["part"], quantiles=[0.5]).where("column_name = 'a'")
    assert [r.rows for r in per_part.orderBy("part").collect()] == [r["count"] for r in df.groupBy("part").count().orderBy("part").collect()]


def test_nulls_odd_numbers_and_other_types(frame):
    df = frame("g string, x double, `a.b` array<int>, s string, d decimal(10,2)", [
        (None, float("nan"), [1], "", None), (None, float("inf"), [1], None, None), ("a", None, None, "x" * 100_000, None), (None, -2.0, [2], "", None),
    ])
    report = {r.column_name: r for r in sketch_report(sketch(df, by=["g"]), quantiles=[0.5]).collect()}
    x = report["x"]
    assert (x.rows, x.nulls, x.nonfinite, x.distinct_estimate) == (4, 1, 2, 3) and abs(x.q50 + 2) <= 0.02
    assert (report["a.b"].nulls, report["a.b"].distinct_estimate, report["a.b"].q50) == (1, 2, None)
    assert (report["s"].rows, report["s"].distinct_estimate) == (4, 2)
    assert (report["d"].rows, report["d"].nulls, report["d"].distinct_estimate, report["d"].q50) == (4, 4, 0, None)
    by_group = sketch_report(sketch(df, by=["g"]), by=["g"], quantiles=[0.5]).where("column_name = 's'")
    assert rows_of(by_group, "g", "rows", "nulls") == [(None, 3, 1), ("a", 1, 0)]


def test_empty_tables_and_clashing_names(frame):
    assert sketch_report(sketch(frame("x double", []))).count() == 0
    assert sketch_report(sketch(frame("n int, kind string", [(1, "a"), (1, "b")])), quantiles=[0.5]).count() == 2
    with pytest.raises(ValueError, match="kind"):
        sketch(frame("x double, kind string", []), by=["kind"])


def test_marks_are_combined_before_they_move(frame):
    plan = sketch(frame("x double", [(1.0,)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange") < plan.rindex("HashAggregate")

from __future__ import annotations

from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from conftest import at, rows_of
from tallywork.session import cluster_settings, input_size, shared_dir, size_session
from tallywork.sources import writers
from tallywork.sources import (
    SCHEMAS, conform, current_version, current_versions, discard, drift_report, manifests, new_version, parse_timestamps, publish, read_domain,
    read_mart, read_versions, row_counts, stage_observed, stage_version, sweep, unparsed_counts, unparsed_report, write_mart,
)


def test_eighteen_declared_tables():
    assert sum(len(tables) for tables in SCHEMAS.values()) == 18
    assert SCHEMAS["telecom"]["raw_usage"]["usage_units"].dataType.simpleString() == "decimal(14,3)"


def test_timestamps_delivered_as_text(frame):
    df = frame("id long, t string", [(1, "2024-01-02 03:04:05"), (2, "2024-01-02T03:04:05.5"), (3, "n/a"), (4, None), (5, "2024")])
    out = parse_timestamps(df, ["t"])
    assert {r.id: (r.t, r.t_unparsed) for r in out.collect()} == {
        1: (at("2024-01-02 03:04:05"), False), 2: (at("2024-01-02 03:04:05.500"), False), 3: (None, True), 4: (None, False), 5: (None, True),
    }
    assert unparsed_counts(out, ["t"]).first().t == 2


def test_declared_schema_is_enforced(frame, spark, tmp_path):
    schema = SCHEMAS["commerce"]["raw_refunds"]
    loose = frame(
        "extra string, refund_id int, order_id int, payment_id int, refund_amount double, currency string, refund_reason string, "
        "refund_status string, requested_at string, processed_at timestamp_ntz",
        [("x", 1, 2, 3, 4.5, "USD", "late", "completed", "2024-01-01 00:00:00", at("2024-01-02"))],
    )
    out = conform(loose, schema)
    assert [f.dataType for f in out.schema] == [f.dataType for f in schema]
    row = out.first()
    assert (row.refund_amount, row.requested_at) == (Decimal("4.50"), at("2024-01-01"))


def test_read_domain_round_trip(feeds, spark, tmp_path):
    raw = feeds.raw("telecom")
    for name, df in raw.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    back = read_domain(spark, str(tmp_path), "telecom")
    assert rows_of(row_counts(back)) == rows_of(row_counts(raw))
    assert back["raw_usage"].schema["usage_units"].dataType == SCHEMAS["telecom"]["raw_usage"]["usage_units"].dataType


def test_failed_version_leaves_the_published_one(frame, spark, tmp_path):
    root = f"{tmp_path}/mart"
    assert current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_mart(spark, root)
    write_mart(frame("v long", [(1,)]), root, "run1")
    version = new_version("run2")
    stage_version(frame("v long", [(2,)]), root, version)          # staged, never published
    assert rows_of(read_mart(spark, root)) == [(1,)]
    publish(spark, str(tmp_path), {"mart": version})
    assert rows_of(read_mart(spark, root)) == [(2,)]
    with pytest.raises(AnalysisException):                         # a version is never written twice
        stage_version(frame("v long", [(3,)]), root, version)
    write_mart(frame("v long", [(3,)]), root, "run2")              # nor is what readers of the same run see
    assert rows_of(read_mart(spark, root)) == [(3,)]
    assert rows_of(spark.read.parquet(f"{root}/v={version}")) == [(2,)]


def test_tables_of_a_run_become_visible_together(frame, spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    for name in ("a", "b"):
        write_mart(frame("v long", [(1,)]), f"{out}/{name}", "r1")
    versions = {name: new_version("r2") for name in ("a", "b")}
    for name, version in versions.items():
        stage_version(frame("v long", [(2,)]), f"{out}/{name}", version)
    before = current_versions(spark, out)
    # A crash while the manifest is written leaves a file no reader looks at.
    monkeypatch.setattr(writers.json, "dumps", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        publish(spark, out, versions)
    monkeypatch.undo()
    assert current_versions(spark, out) == before and rows_of(read_mart(spark, f"{out}/a")) == [(1,)]
    publish(spark, out, versions)
    assert current_versions(spark, out) == versions
    assert [rows_of(read_mart(spark, f"{out}/{name}")) for name in versions] == [[(2,)], [(2,)]]


def test_timestamps_with_zones_and_without_seconds(frame):
    texts = {
        "2024-01-01T00:00:00Z": "2024-01-01", "2024-01-01 00:00": "2024-01-01", "2024-01-01T02:00:00+02:00": "2024-01-01",
        "2024-01-01 00:00:00.25-0130": "2024-01-01 01:30:00.250", "2024-01-01": "2024-01-01", "01/02/2024": None, "2024-13-01 00:00:00": None,
    }
    out = parse_timestamps(frame("s string, t string", [(t, t) for t in texts]), ["t"])
    assert {r.s: (r.t, r.t_unparsed) for r in out.collect()} == {t: (at(e), e is None) for t, e in texts.items()}


def test_what_cannot_be_read_is_counted(frame):
    tables = {"raw_refunds": frame("refund_id long, requested_at string, processed_at timestamp_ntz", [(1, "soon", None), (2, "2024-01-01", None), (3, None, None)])}
    schema = {"raw_refunds": T.StructType([f for f in SCHEMAS["commerce"]["raw_refunds"] if f.name in tables["raw_refunds"].columns])}
    assert rows_of(unparsed_report(tables, schema)) == [("raw_refunds", "unparsed(requested_at)", "error", 1, "error")]
    assert unparsed_report({"raw_refunds": tables["raw_refunds"].drop("requested_at")}, {"raw_refunds": T.StructType([schema["raw_refunds"]["processed_at"]])}) is None


def _session(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)))


def test_shared_dir_is_the_one_the_cluster_names(spark):
    assert shared_dir(spark) == shared_dir(spark)                  # local fallback, made once
    named = {"spark.checkpoint.dir": "hdfs://shared/checkpoints/", "spark.master": "yarn"}
    assert shared_dir(_session(**named)) == "hdfs://shared/checkpoints"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session(**{"spark.master": "yarn"}))


def test_shuffle_partitions_grow_with_the_input():
    counts = [int(cluster_settings(size)["spark.sql.shuffle.partitions"]) for size in (2**30, 2**40, 100 * 2**40, 1000 * 2**40)]
    assert counts == [200, 8192, 819_200, 8_192_000]


def test_a_running_session_is_sized_for_its_input(frame, spark, tmp_path):
    frame("v long", [(1,)]).write.parquet(f"{tmp_path}/t.parquet")
    assert 0 < input_size(spark, str(tmp_path)) < 10_000
    before = {k: spark.conf.get(k, None) for k in cluster_settings(1)}
    try:
        assert size_session(spark, str(tmp_path))["spark.sql.shuffle.partitions"] == "200"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_two_publishers_of_one_folder_both_stay(frame, spark, tmp_path, monkeypatch):
    """Both have listed the same manifests; the second to claim the number reads the first one's and takes the next."""
    out = str(tmp_path)
    write_mart(frame("v long", [(0,)]), f"{out}/a", "r0")
    staged = {name: new_version("r1") for name in ("commerce", "rides")}
    for i, (name, version) in enumerate(staged.items()):
        stage_version(frame("v long", [(i,)]), f"{out}/{name}", version)
    plain, held = writers._manifest_files, []

    def interleaved(session, folder):
        files = plain(session, folder)
        if not held:                       # the other publisher gets in between listing and claiming
            held.append(True)
            publish(session, folder, {"commerce": staged["commerce"]})
        return files

    monkeypatch.setattr(writers, "_manifest_files", interleaved)
    publish(spark, out, {"rides": staged["rides"]})
    monkeypatch.undo()
    versions = current_versions(spark, out)
    assert {k: versions[k] for k in staged} == staged and "a" in versions and sorted(manifests(spark, out)) == [1, 2, 3]


def test_many_publishers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    with ThreadPoolExecutor(8) as pool:
        run = inheritable_thread_target(spark)(lambda i: publish(spark, str(tmp_path), {f"t{i}": f"v{i}"}))
        numbers = sorted(pool.map(run, range(16)))
    assert numbers == list(range(1, 17)) and current_versions(spark, str(tmp_path)) == {f"t{i}": f"v{i}" for i in range(16)}
    assert not [p for p in (tmp_path / "_manifests").iterdir() if p.name.endswith(".tmp")]


def test_a_sweep_keeps_what_kept_manifests_reach(frame, spark, tmp_path):
    out = str(tmp_path)
    for i in range(4):
        write_mart(frame("v long", [(i,)]), f"{out}/mart", f"r{i}")
    write_mart(frame("v long", [(9,)]), f"{out}/other", "r9")
    staged = new_version("unpublished")
    stage_version(frame("v long", [(5,)]), f"{out}/mart", staged)
    reader = read_versions(spark, out, "mart")
    assert sorted(reader) == [1, 2, 3, 4]
    removed = sweep(spark, out, keep=3)
    assert len(removed) == 4 and sorted(manifests(spark, out)) == [3, 4, 5]     # two manifests and the versions only they named
    assert [rows_of(reader[n]) for n in (3, 4)] == [[(2,)], [(3,)]]
    assert rows_of(read_mart(spark, f"{out}/other")) == [(9,)] and rows_of(spark.read.parquet(f"{out}/mart/v={staged}")) == [(5,)]
    discard(spark, out, {"mart": staged, "other": current_versions(spark, out)["other"]})
    assert not (tmp_path / f"mart/v={staged}").exists() and rows_of(read_mart(spark, f"{out}/other")) == [(9,)]


def test_drift_is_a_line_of_the_report(frame):
    schema = {"raw_refunds": SCHEMAS["commerce"]["raw_refunds"]}
    kinds = {f.name: f.dataType.simpleString() for f in schema["raw_refunds"].fields}
    kinds.pop("refund_reason")
    kinds["refund_id"] = "string"
    got = frame(", ".join(f"{c} {k}" for c, k in {**kinds, "agent": "string"}.items()), [])
    spark = got.sparkSession
    assert rows_of(drift_report(spark, {"raw_refunds": got}, schema), "check_name", "status") == [
        ("extra_column(agent)", "warn"), ("missing_column(refund_reason)", "error"), ("retyped_column(refund_id: bigint as string)", "warn"),
    ]
    with pytest.raises(ValueError, match="raw_refunds lacks refund_reason"):
        conform(got, schema["raw_refunds"], "raw_refunds")
    assert conform(got, schema["raw_refunds"], strict=False).schema["refund_reason"].dataType == T.StringType()
    assert drift_report(spark, {"raw_refunds": conform(got, schema["raw_refunds"], strict=False)}, schema) is None


def test_measures_are_taken_while_a_table_is_written(frame, spark, tmp_path):
    df = frame("v long, part string", [(i, str(i % 3)) for i in range(100)] + [(None, None)]).repartition(7, "part")
    measures = {"rows": F.count(F.lit(1)), ("nulls", "v"): F.count_if(F.col("v").isNull()), "ratio": F.expr("sum(v) / count(v)"), "none": F.max(F.when(F.col("v") < 0, 1))}
    staged, seen = stage_observed(df, f"{tmp_path}/t", "v1", measures, partition_by=("part",))
    assert seen == {"rows": 101, ("nulls", "v"): 1, "ratio": 49.5, "none": None} and staged.count() == 101
    empty, seen = stage_observed(df.where("v < 0").groupBy("v").count(), f"{tmp_path}/t", "v2", {"rows": F.count(F.lit(1))})
    assert seen == {"rows": 0} and empty.columns == ["v", "count"] and empty.count() == 0
    assert stage_observed(df, f"{tmp_path}/t", "v3", {})[1] == {}
    with pytest.raises(Exception, match="already exists"):
        stage_observed(df, f"{tmp_path}/t", "v3", measures)

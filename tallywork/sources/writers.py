"""Full-refresh mart sink: every attempt writes new folders, one manifest per run makes them visible.

``<out>/<table>/v=<version>/`` holds what one attempt wrote; a version is never written twice, so neither a retry nor a second
run of the same name can touch what readers see.  ``<out>/_manifests/<number>.json`` names the versions of all tables of the
folder.  Numbers are taken one by one: a publisher writes its manifest under another name and claims the next number, which only one can;
whoever comes second reads the manifest of the first, adds its own tables and claims the number after.  So runs that publish to
one folder side by side all stay, and readers see all tables of a run or none.  A run that fails, is rejected or dies leaves the
last manifest alone.  ``sweep`` removes what no kept manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Hashable, Mapping
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

_MANIFESTS = "_manifests"


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _split(root: str) -> tuple[str, str]:
    out, _, table = root.rstrip("/").rpartition("/")
    return out, table


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/v={version}"


def new_version(run: str) -> str:
    """A version of its own for one attempt of a run."""
    return f"{run}-{uuid.uuid4().hex[:8]}"


def stage_version(df: DataFrame, root: str, version: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a new version and return it as read back, cut from the plan that made it; an existing one is an error."""
    path = version_path(root, version)
    df.write.mode("error").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_observed(
    df: DataFrame, root: str, version: str, measures: Mapping[Hashable, Column], partition_by: tuple[str, ...] = (),
) -> tuple[DataFrame, dict[Hashable, Any]]:
    """Like ``stage_version``, with aggregates of the rows taken while they are written, so nothing has to be read for them.

    The aggregates are part of the stage that writes, where the rows of a task that ran twice count once.  Distinct
    aggregates cannot be observed.
    """
    if not measures:
        return stage_version(df, root, version, partition_by), {}
    seen = Observation()
    columns = [column.alias(f"m{i}") for i, column in enumerate(measures.values())]
    staged = stage_version(df.observe(seen, *columns), root, version, partition_by)
    found = seen.get
    return staged, {key: found[f"m{i}"] for i, key in enumerate(measures)}


def _manifest_files(spark: SparkSession, out: str) -> list[str]:
    fs, folder = _file(spark, f"{out.rstrip('/')}/{_MANIFESTS}")
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))


def _read(spark: SparkSession, path: str) -> str:
    fs, target = _file(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current_versions(spark: SparkSession, out: str) -> dict[str, str]:
    """Published version of every table below ``out``."""
    files = _manifest_files(spark, out)
    return json.loads(_read(spark, f"{out.rstrip('/')}/{_MANIFESTS}/{files[-1]}")) if files else {}


def _number(file: str) -> int:
    return int(file.split(".", 1)[0].split("-", 1)[0])


def _claim(spark: SparkSession, unfinished: str, final: str) -> bool:
    """Give a written file its final name if no other has it; False if one has.

    A rename refuses an existing target on HDFS and on stores with an atomic one.  On a local disk it would replace it, so there a
    link is made, which never does.
    """
    fs, source = _file(spark, unfinished)
    _, target = _file(spark, final)
    if source.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return not fs.exists(target) and fs.rename(source, target)
    local = lambda path: spark._jvm.java.io.File(path.toUri().getPath()).toPath()
    try:
        spark._jvm.java.nio.file.Files.createLink(local(target), local(source))
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        return False
    finally:
        fs.delete(source, False)
    return True


def publish(spark: SparkSession, out: str, versions: Mapping[str, str]) -> int:
    """Make staged versions of some tables current, all at once; other tables stay as they are.  Returns the manifest's number."""
    folder = f"{out.rstrip('/')}/{_MANIFESTS}"
    while True:
        files = _manifest_files(spark, out)
        number = _number(files[-1]) + 1 if files else 1
        current = json.loads(_read(spark, f"{folder}/{files[-1]}")) if files else {}
        unfinished = f"{folder}/.{number:09d}-{uuid.uuid4().hex[:8]}.tmp"
        fs, path = _file(spark, unfinished)
        stream = fs.create(path, False)
        stream.write(bytearray(json.dumps({**current, **versions}, sort_keys=True), "utf-8"))
        stream.close()
        if _claim(spark, unfinished, f"{folder}/{number:09d}.json"):
            return number


def manifests(spark: SparkSession, out: str) -> dict[int, dict[str, str]]:
    """Versions of all tables by manifest number, oldest first."""
    return {_number(f): json.loads(_read(spark, f"{out.rstrip('/')}/{_MANIFESTS}/{f}")) for f in _manifest_files(spark, out)}


def sweep(spark: SparkSession, out: str, keep: int) -> list[str]:
    """Remove the manifests but the last ``keep``, and every version that only those named; returns the removed paths.

    Readers of a kept manifest keep all its tables.  A version that no manifest names may be one that a run is about to publish, so
    it stays; what a rejected run left is removed by ``discard``.
    """
    if keep < 1:
        raise ValueError("the last manifest stays")
    log, out = manifests(spark, out), out.rstrip("/")
    old, kept = sorted(log)[:-keep], sorted(log)[-keep:]
    reached = {(t, v) for n in kept for t, v in log[n].items()}
    gone = sorted({(t, v) for n in old for t, v in log[n].items()} - reached)
    # Manifests go first: a crash in between leaves versions without a reader, never a reader without its versions.
    paths = [f"{out}/{_MANIFESTS}/{f}" for f in _manifest_files(spark, out) if _number(f) in old]
    paths += [version_path(f"{out}/{t}", v) for t, v in gone]
    for path in paths:
        fs, target = _file(spark, path)
        fs.delete(target, True)
    return paths


def discard(spark: SparkSession, out: str, versions: Mapping[str, str]) -> None:
    """Remove staged versions that were never published, as of a rejected run."""
    named = {(t, v) for versions_ in manifests(spark, out).values() for t, v in versions_.items()}
    for table, version in versions.items():
        if (table, version) not in named:
            fs, target = _file(spark, version_path(f"{out.rstrip('/')}/{table}", version))
            fs.delete(target, True)


def read_versions(spark: SparkSession, out: str, table: str) -> dict[int, DataFrame]:
    """Every kept version of a table by the first manifest that names it, oldest first."""
    first: dict[str, int] = {}
    for number, versions in manifests(spark, out).items():
        if table in versions:
            first.setdefault(versions[table], number)
    return {number: spark.read.parquet(version_path(f"{out.rstrip('/')}/{table}", version)) for version, number in first.items()}


def current_version(spark: SparkSession, root: str) -> str | None:
    out, table = _split(root)
    return current_versions(spark, out).get(table)


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.parquet(version_path(root, version))


def write_mart(df: DataFrame, root: str, run: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Stage and publish in one step, for marts without checks."""
    out, table = _split(root)
    version = new_version(run)
    staged = stage_version(df, root, version, partition_by)
    publish(df.sparkSession, out, {table: version})
    return staged

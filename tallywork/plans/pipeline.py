"""The gated run: freshness, a snapshot of the feeds, intermediate, marts, checks, and only then publication."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from types import ModuleType

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywork.functions.aggregates import row_count
from tallywork.operators._union import union_all
from tallywork.operators.quality import Check, DataQualityError, enforce, freshness, observable, run_checks
from tallywork.sources.writers import discard, new_version, publish, read_mart, stage_observed, stage_version

HISTORY = "_history"
_HISTORY_SCHEMA = "run string, version string, ended_at timestamp, kind string, subject string, status string, value double"


@dataclass
class RunResult:
    run: str
    marts: dict[str, DataFrame]
    freshness: list = field(default_factory=list)
    checks: list = field(default_factory=list)


def freshness_report(domain: ModuleType, raw: Mapping[str, DataFrame], as_of) -> DataFrame:
    return union_all([
        freshness(raw[source], source, column, warn, error, as_of, blocking)
        for source, (column, warn, error, blocking) in domain.FRESHNESS.items()
    ])


def stage(domain: ModuleType, raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging layer: one lazy DataFrame per model."""
    return {name: model(raw) for name, model in domain.STAGING.items()}


def checked(domain: ModuleType, raw: Mapping[str, DataFrame], checks: Sequence[Check]) -> dict[str, DataFrame]:
    """The tables that checks on feeds and staging read.

    A staging model that only adds flags has the rows and keys of its feed; checks that need no flag of it read the feed,
    which spares the work that makes the flags.
    """
    out = {**raw, **stage(domain, raw)}
    for model, feed in domain.FLAGS_ONLY.items():
        used = {c for k in checks if k.table == model for c in k.columns} | {k.parent_key for k in checks if k.parent == model}
        bare = all(k.kind in ("unique", "not_null", "accepted_values", "relationship") for k in checks if model in (k.table, k.ledger))
        if bare and used <= set(raw[feed].columns):
            out[model] = raw[feed]
    return out


def build(domain: ModuleType, raw: Mapping[str, DataFrame], **options) -> dict[str, DataFrame]:
    """Every model of a domain as lazy DataFrames; nothing runs here."""
    inter = domain.intermediate(raw, **options)
    return {**raw, **stage(domain, raw), domain.INTERMEDIATE: inter, **domain.marts(inter, raw)}


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Make models available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in tables]


def _side_by_side(spark: SparkSession, tables: Mapping[str, DataFrame], write: Callable) -> dict:
    """Tables that do not depend on each other, written at the same time by ``write(name, table)``."""
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        task = inheritable_thread_target(spark)(lambda item: write(*item))
        return dict(zip(tables, pool.map(task, tables.items())))


@dataclass
class Written:
    """Written tables and what was observed of them: rows, headlines, and failures of flat rules."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    headlines: dict[str, float | None] = field(default_factory=dict)
    failures: dict[Check, int] = field(default_factory=dict)


def materialise(
    spark: SparkSession, domain: ModuleType, raw: Mapping[str, DataFrame], out: str, version: str, checks: Sequence[Check] = (), **options,
) -> Written:
    """Intermediate and marts as written tables, their rows, headlines and flat rules counted by the same jobs.

    The intermediate feeds several marts, so it is written once and read back: every mart then scans a finished table, and a
    lost executor costs one partition of one stage, not the whole lineage.
    """
    done, rules, headlines = Written(), observable(checks), getattr(domain, "HEADLINES", {})

    def write(name: str, table: DataFrame) -> tuple[DataFrame, dict]:
        watched = {h: F.expr(rule) for h, (of, rule) in headlines.items() if of == name}
        return stage_observed(table, f"{out}/{name}", version, {"rows": row_count(), **watched, **rules.get(name, {})})

    def keep(name: str, table: DataFrame, seen: dict) -> DataFrame:
        done.tables[name], done.rows[name] = table, seen.pop("rows")
        for what, value in seen.items():
            if isinstance(what, Check):
                done.failures[what] = value
            else:
                done.headlines[what] = None if value is None else float(value)
        return table

    inter = keep(domain.INTERMEDIATE, *write(domain.INTERMEDIATE, domain.intermediate(raw, **options)))
    for name, (table, seen) in _side_by_side(spark, domain.marts(inter, raw), write).items():
        keep(name, table, seen)
    return done


def run_domain(
    spark: SparkSession, domain: ModuleType, raw: Mapping[str, DataFrame], out: str, run: str, as_of=None,
    checks: list[Check] | None = None, reports: Sequence[DataFrame] = (), snapshot: bool = True, keep_rejected: bool = False, **options,
) -> RunResult:
    """Build, check and publish one domain.

    The feeds are written once and everything reads that snapshot, so the checks test the very rows the marts were built
    from, whatever arrives meanwhile; with ``snapshot=False`` they are read as they are, for feeds that cannot change.
    Marts are written as a new version, checked as written, and become visible together when no error-level check, tie-out or
    row of ``reports`` (check reports made elsewhere) fails.  What a run found is added to the history, also if it is rejected; what
    a rejected run has written is removed, unless ``keep_rejected``.  The manifest names the snapshot next to the marts, so ``sweep``
    keeps the one that belongs to them, and ``read_versions`` finds earlier ones.
    """
    out, version = out.rstrip("/"), new_version(run)
    fresh = []
    if as_of is not None:
        fresh = freshness_report(domain, raw, as_of).collect()
        stale = sorted(row.source for row in fresh if row.status == "error")
        if stale:
            raise DataQualityError(f"stale sources: {', '.join(stale)}")
    feeds = f"_feeds/{domain.__name__.rpartition('.')[2]}"
    staged = {}
    if snapshot:
        raw = _side_by_side(spark, dict(raw), lambda name, df: stage_version(df, f"{out}/{feeds}/{name}", version))
        staged = {f"{feeds}/{name}": version for name in raw}
    checks = domain.CHECKS if checks is None else checks
    built = materialise(spark, domain, raw, out, version, checks, **options)
    marts = [name for name in built.tables if name != domain.INTERMEDIATE]
    report = union_all([run_checks({**checked(domain, raw, checks), **built.tables}, checks, built.failures), *reports])
    rows = report.collect()
    _remember(spark, out, run, version, fresh, rows, {name: built.rows[name] for name in marts}, built.headlines)
    staged |= {name: version for name in built.tables}
    try:
        enforce(rows)
    except DataQualityError:
        if not keep_rejected:
            discard(spark, out, staged)
        raise
    publish(spark, out, staged)
    return RunResult(run, {name: read_mart(spark, f"{out}/{name}") for name in marts}, fresh, rows)


# ---- history ------------------------------------------------------------------------

def _remember(spark: SparkSession, out: str, run: str, version: str, fresh: list, checks: list, counts: Mapping[str, int], measures: Mapping[str, float | None]) -> None:
    """Append what a run found: a row per freshness source, check, mart and headline."""
    now = datetime.now(timezone.utc)
    rows = [("freshness", r.source, r.status, None) for r in fresh]
    rows += [("check", f"{r.table_name}: {r.check_name}", r.status, float(r.failures)) for r in checks]
    rows += [("rows", name, None, float(n)) for name, n in counts.items()] + [("headline", name, None, v) for name, v in measures.items()]
    spark.createDataFrame([(run, version, now, *r) for r in rows], _HISTORY_SCHEMA).coalesce(1).write.mode("append").parquet(f"{out}/{HISTORY}")


def read_history(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(_HISTORY_SCHEMA).parquet(f"{out.rstrip('/')}/{HISTORY}")

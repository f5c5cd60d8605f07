"""Data-quality gates: declared checks, severities, freshness.

Severities.  A check is an error unless declared otherwise.  The domains declare generic tests (``unique``, ``not_null``,
``accepted_values``, ``relationship``) as warnings: they describe dirt that the models are built to survive, and the report
shows it.  Business rules and ledger tie-outs stay errors: a mart that breaks one is not published.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallywork.functions.times import ntz
from tallywork.operators._union import union_all


class DataQualityError(RuntimeError):
    """Raised when a check of severity ``error`` fails."""


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_key: str = ""
    rule: str = ""
    severity: str = "error"
    ledger: str = ""
    ledger_rule: str = ""

    @property
    def name(self) -> str:
        subject = self.rule or "+".join(self.columns)
        target = f"->{self.parent}.{self.parent_key}" if self.parent else f"={self.ledger}.{self.ledger_rule}" if self.ledger else ""
        return f"{self.kind}({subject}{target})"


def unique(table: str, *columns: str, severity: str = "error") -> Check:
    return Check(table, "unique", columns, severity=severity)


def not_null(table: str, column: str, severity: str = "error") -> Check:
    return Check(table, "not_null", (column,), severity=severity)


def accepted(table: str, column: str, values: Sequence[str], severity: str = "error") -> Check:
    return Check(table, "accepted_values", (column,), tuple(values), severity=severity)


def relationship(table: str, column: str, parent: str, parent_key: str, severity: str = "error") -> Check:
    return Check(table, "relationship", (column,), parent=parent, parent_key=parent_key, severity=severity)


def expression(table: str, rule: str, severity: str = "error") -> Check:
    return Check(table, "expression", rule=rule, severity=severity)


def tie_out_check(table: str, total: str, ledger: str, ledger_total: str, severity: str = "error") -> Check:
    """An aggregate of a mart equals, to the penny, one of the ledger it comes from; a missing total is zero."""
    return Check(table, "tie_out", rule=total, severity=severity, ledger=ledger, ledger_rule=ledger_total)


def generic_warn(checks: Sequence[Check]) -> list[Check]:
    """The checks with generic tests lowered to warnings; rules and tie-outs as declared."""
    generic = {"unique", "not_null", "accepted_values", "relationship"}
    return [replace(c, severity="warn") if c.kind in generic else c for c in checks]


def _row_rule(check: Check) -> Column:
    """Condition that holds for the rows a row-level check rejects; unknown passes."""
    if check.kind == "not_null":
        return F.col(check.columns[0]).isNull()
    if check.kind == "accepted_values":
        return ~F.col(check.columns[0]).isin(*check.values)
    return ~F.expr(check.rule)


def observable(checks: Sequence[Check]) -> dict[str, dict[Check, Column]]:
    """By table, the aggregates that count what flat rules reject: those that look at one row at a time.

    They can be taken while a table is written and handed to ``run_checks``.
    """
    out: dict[str, dict[Check, Column]] = defaultdict(dict)
    for check in checks:
        if check.kind in ("not_null", "accepted_values", "expression"):
            out[check.table][check] = F.count_if(_row_rule(check))
    return dict(out)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent and the rows that carry them.

    The child is counted per key first, so a hot key is one row when it reaches the join.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("orphan_key")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    known = parent.select(F.col(parent_key).alias("__known"))
    return counted.join(known, F.col("orphan_key") == F.col("__known"), "left_anti")


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _marks(number: int, check: Check, table: str, tables: Mapping[str, DataFrame]) -> list[Column]:
    """What a row of ``table`` says about a check: a struct, or NULL where it says nothing.

    A key of one integer column travels as a number, every other key as texts.
    """
    def mark(when: Column, key: list[Column], parent: bool, kind: T.DataType | None = None) -> Column:
        whole = isinstance(kind, _INTEGERS)
        return F.when(when, F.struct(
            F.lit(number).alias("check"), (key[0] if whole else F.lit(None)).cast("bigint").alias("number"),
            (F.array(*[k.cast("string") for k in key]) if key and not whole else F.lit(None)).cast("array<string>").alias("key"), F.lit(parent).alias("parent"),
        ))

    if check.kind == "unique":
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in check.columns])
        only = tables[table].schema[check.columns[0]].dataType if len(check.columns) == 1 else None
        return [mark(complete, [F.col(c) for c in check.columns], False, only)]
    if check.kind != "relationship":
        return [mark(_row_rule(check), [], False)]
    out, kind = [], tables[check.parent].schema[check.parent_key].dataType
    if table == check.table:
        out.append(mark(F.col(check.columns[0]).isNotNull(), [F.col(check.columns[0]).cast(kind)], False, kind))
    if table == check.parent:
        out.append(mark(F.col(check.parent_key).isNotNull(), [F.col(check.parent_key)], True, kind))
    return out


def _tie(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    zero = lambda rule: F.coalesce(F.expr(rule), F.lit(0))
    ledger = tables[check.ledger].agg(zero(check.ledger_rule)).scalar()
    return tables[check.table].agg(zero(check.rule).alias("total")).select(_line(check, (F.col("total") != ledger).cast("int")))


def _line(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"), F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"), failures.cast("bigint").alias("failures"),
    ).alias("line")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check], counted: Mapping[Check, int] | None = None) -> DataFrame:
    """Report (table_name, check_name, severity, failures, status), one row per check.

    Every table is read once and everything meets in one exchange: a row gives a mark for each rule it breaks and for each
    key that a check counts or looks up, the marks are counted per check and key before the exchange, and a key that
    repeats or has no parent is seen after it.  ``failures`` counts rejected rows, for ``unique`` the keys that repeat, for
    ``tie_out`` 1 if the totals differ.  Checks whose failures are in ``counted``, because they were taken while the table was
    written, read nothing.  Without checks the report is empty.
    """
    counted = counted or {}
    marked: dict[str, list[Column]] = defaultdict(list)
    keyed = [c for c in checks if c.kind != "tie_out" and c not in counted]
    for number, check in enumerate(keyed):
        for table in dict.fromkeys([check.table, check.parent or check.table]):
            marked[table] += _marks(number, check, table, tables)
    parts: list[DataFrame] = []
    if keyed:
        marks = [
            tables[table].select(F.explode(F.filter(F.array(*columns), lambda m: m.isNotNull())).alias("m")).select("m.*")
            for table, columns in marked.items()
        ]
        n = F.count_if(~F.col("parent"))
        met = union_all(marks).groupBy("check", "number", "key").agg(n.alias("n"), F.bool_or("parent").alias("known"))
        per_check = met.groupBy("check").agg(
            F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"),
            F.coalesce(F.sum(F.when(~F.col("known"), F.col("n"))), F.lit(0)).alias("orphaned"),
        )
        # One entry per declared check, so the single row stays small.
        found = per_check.agg(F.map_from_entries(F.collect_list(F.struct("check", F.struct("rows", "repeated", "orphaned")))).alias("found"))
        field = {"unique": "repeated", "relationship": "orphaned"}
        lines = [_line(c, F.coalesce(F.col("found")[i][field.get(c.kind, "rows")], F.lit(0))) for i, c in enumerate(keyed)]
        parts.append(found.select(F.explode(F.array(*lines)).alias("line")))
    parts += [_tie(c, tables) for c in checks if c.kind == "tie_out"]
    known = [(c.table, c.name, c.severity, int(counted[c])) for c in checks if c in counted]
    lines = [part.select("line.*") for part in parts]
    if known or not lines:
        spark = next(iter(tables.values())).sparkSession
        lines.append(spark.createDataFrame(known, "table_name string, check_name string, severity string, failures bigint"))
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "error", "error").otherwise("warn")
    return union_all(lines).withColumn("status", status)


def enforce(report: DataFrame | list) -> list:
    """Raise when an error-level check of a report (one row per declared check) fails; returns its rows."""
    rows = report if isinstance(report, list) else report.collect()
    broken = [f"{r.table_name}: {r.check_name} ({r.failures})" for r in rows if r.status == "error"]
    if broken:
        raise DataQualityError("; ".join(sorted(broken)))
    return rows


def freshness(df: DataFrame, source: str, loaded_at: str, warn_hours: int, error_hours: int, as_of, blocking: bool = True) -> DataFrame:
    """One row: latest load, its age and a status against two thresholds; no load at all is an error.

    A source that is not ``blocking`` can only warn.
    """
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = ntz(as_of) - F.col("max_loaded_at")
    worst = F.lit("error" if blocking else "warn")
    status = (
        F.when(F.col("max_loaded_at").isNull() | (age > F.make_dt_interval(hours=F.lit(error_hours))), worst)
        .when(age > F.make_dt_interval(hours=F.lit(warn_hours)), "warn")
        .otherwise("pass")
    )
    return newest.select(
        F.lit(source).alias("source"), "max_loaded_at", F.lit(warn_hours).alias("warn_hours"),
        F.lit(error_hours).alias("error_hours"), status.alias("status"),
    )

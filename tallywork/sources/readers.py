"""Read raw tables under their declared schema, and repair what feeds get wrong."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallywork.operators._union import union_all
from tallywork.sources.schemas import SCHEMAS

_DATE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_TIME = "[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?"
_ISO = f"^{_DATE}([ T]{_TIME})?$"
_ZONED = f"^{_DATE}[ T]{_TIME} ?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$"


def _parsed(column: str) -> Column:
    return F.expr(_parsed_sql(column))


def _parsed_sql(column: str) -> str:
    """ISO dates and times, seconds optional; with a zone, the same instant in UTC."""
    instant = f"try_cast(`{column}` AS timestamp)"
    return (
        f"CASE WHEN `{column}` RLIKE '{_ISO}' THEN try_cast(`{column}` AS timestamp_ntz) "
        f"WHEN `{column}` RLIKE '{_ZONED}' THEN convert_timezone(current_timezone(), 'UTC', CAST({instant} AS timestamp_ntz)) END"
    )


def parse_timestamps(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ISO strings to ``timestamp_ntz``; text that is no timestamp becomes NULL and is flagged."""
    parsed = {c: _parsed(c) for c in cols}
    flags = {f"{c}_unparsed": F.col(c).isNotNull() & parsed[c].isNull() for c in cols}
    return df.withColumns(flags | parsed)


def unparsed_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the number of unparseable values per column of ``parse_timestamps`` output."""
    return df.agg(*[F.count_if(F.col(f"{c}_unparsed")).alias(c) for c in cols])


def conform(df: DataFrame, schema: T.StructType, name: str = "table", strict: bool = True) -> DataFrame:
    """Select and cast to the declared columns; timestamps delivered as text are parsed.

    A declared column that was not delivered is an error that names it; with ``strict=False`` it is NULL, for runs that put it
    into their report (``drift_report``).
    """
    delivered = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in delivered]
    if missing and strict:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    columns = []
    for field in schema.fields:
        if field.name in missing:
            columns.append(f"CAST(NULL AS {field.dataType.simpleString()}) AS `{field.name}`")
            continue
        text = isinstance(field.dataType, T.TimestampNTZType) and isinstance(delivered[field.name], T.StringType)
        value = _parsed_sql(field.name) if text else f"`{field.name}`"
        columns.append(f"CAST({value} AS {field.dataType.simpleString()}) AS `{field.name}`")
    return df.selectExpr(*columns)


def delivered(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One raw table as it was delivered."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_raw(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None, strict: bool = True) -> DataFrame:
    """One raw table; a declared schema is enforced by casts, so that types may drift at the source."""
    df = delivered(spark, folder, name)
    return conform(df, schema, name, strict) if schema is not None else df


def read_domain(spark: SparkSession, folder: str, domain: str, strict: bool = True) -> dict[str, DataFrame]:
    """All raw tables of a domain from ``<folder>/<table>.parquet``."""
    return {name: read_raw(spark, folder, name, schema, strict) for name, schema in SCHEMAS[domain].items()}


_REPORT = "table_name string, check_name string, severity string, failures long, status string"


def drift_report(spark: SparkSession, tables: Mapping[str, DataFrame], schemas: Mapping[str, T.StructType]) -> DataFrame | None:
    """How delivered tables differ from their declared schemas, in the shape of a check report; no table is read.

    A missing column is an error, since every number made from it would be NULL; an extra or retyped one is a warning, as it is
    dropped or cast.  What a cast cannot read is counted by ``unparsed_report`` and the checks.  None if nothing differs.
    """
    rows = []
    for name, schema in schemas.items():
        got = {f.name: f.dataType.simpleString() for f in tables[name].schema.fields}
        want = {f.name: f.dataType.simpleString() for f in schema.fields}
        rows += [(name, f"missing_column({c})", "error", 1, "error") for c in want if c not in got]
        rows += [(name, f"extra_column({c})", "warn", 1, "warn") for c in got if c not in want]
        rows += [(name, f"retyped_column({c}: {kind} as {got[c]})", "warn", 1, "warn") for c, kind in want.items() if got.get(c, kind) != kind]
    return spark.createDataFrame(rows, _REPORT) if rows else None


def unparsed_report(tables: Mapping[str, DataFrame], schemas: Mapping[str, T.StructType], severity: str = "error") -> DataFrame | None:
    """What ``conform`` cannot read, in the shape of a check report: one row per timestamp that was delivered as text.

    ``tables`` are the tables as delivered.  None if every timestamp has a type of its own.
    """
    parts = []
    for name, schema in schemas.items():
        kinds = {f.name: f.dataType for f in tables[name].schema.fields}
        texts = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType) and isinstance(kinds.get(f.name), T.StringType)]
        if texts:
            counted = tables[name].agg(*[F.count_if(F.col(c).isNotNull() & _parsed(c).isNull()).alias(c) for c in texts])
            lines = [F.struct(
                F.lit(name).alias("table_name"), F.lit(f"unparsed({c})").alias("check_name"), F.lit(severity).alias("severity"),
                F.col(c).alias("failures"), F.when(F.col(c) == 0, "pass").otherwise(severity).alias("status"),
            ) for c in texts]
            parts.append(counted.select(F.inline(F.array(*lines))))
    return union_all(parts) if parts else None


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Manifest after a load: one row per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return union_all(counted)

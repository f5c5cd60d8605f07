"""What the executors share: written tables that cut lineage, and this package's code."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.session import shared_dir

_SHIPPED: set[str] = set()
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000}
#: Bits of a map of 64-bit values, 8 MB.  Beyond so many values it lets more through to the join that decides.
MAP_BITS = 26
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with more underscores before it, such that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lost executor costs no recomputation, a later plan starts here.

    Nothing reads the shuffle files of the write again, so Spark is told to remove them when it ends.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A written table that is removed at the end; what was made from it must be written by then."""
    spark = df.sparkSession
    table = written(df, name)
    try:
        yield table
    finally:
        remove(table)


def remove(table: DataFrame) -> None:
    """Delete the files of a written table that nothing reads any more."""
    spark = table.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bit_map(df: DataFrame, column: str, bits: int = MAP_BITS) -> np.ndarray:
    """A map of the values of a long column by their low ``bits``, of one size whatever their number: a superset of them."""
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1
    parts = df.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for part in parts:
        held = np.frombuffer(bytes(part.bits), dtype=np.uint8)
        out[(part.b - 1) * len(held) : part.b * len(held)] = held
    return out


def bits_of(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit values a map may hold."""
    at = values & np.uint64(8 * len(known) - 1)
    return (known[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def ship(spark: SparkSession) -> SparkSession:
    """Make a session ready for the operators that run Python in tasks.

    This package is sent to the executors once per application, as ``--py-files`` would; the driver serves the archive.  Arrow
    batches are kept small, since whole texts of any length are in them and every worker holds a few.
    """
    for name, most in _BATCH.items():
        if int(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.join(tempfile.mkdtemp(prefix="tallywork-code-"), "tallywork.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(os.path.join(top, "tallywork")):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, top))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
    return spark

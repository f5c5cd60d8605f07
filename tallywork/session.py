"""Session settings the operators rely on, for local tests and for clusters."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Settings that change results or plan shape; safe on any cluster size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even when the next operator then needs another exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Column call sites are recorded for error messages only; it costs more than small plans take to run.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_LOCAL_FALLBACK = "tallywork.local.shared.dir"


def cluster_settings(input_bytes: int, partition_bytes: int = 128 * 2**20) -> dict[str, str]:
    """Sizing for an input: enough shuffle partitions to hold it, however large; AQE merges what turns out small.

    A shuffle of the pruned input is smaller than the input, so a partition never exceeds ``partition_bytes`` by plan.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def input_size(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder, as its file system counts them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def size_session(spark: SparkSession, folder: str) -> dict[str, str]:
    """Size a running session for the files below ``folder``; returns what was set.

    The number of partitions never falls below what the caller has set, and settings that only a new session can take are
    left alone.
    """
    wanted = cluster_settings(input_size(spark, folder))
    name = "spark.sql.shuffle.partitions"
    wanted[name] = str(max(int(wanted[name]), int(spark.conf.get(name))))
    for key, value in wanted.items():
        spark.conf.set(key, value)
    return wanted


def apply_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def local_session(app: str = "tallywork", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    shuffle = str(cores) if str(cores).isdigit() else str(os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", shuffle)
    )
    spark = apply_settings(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: there driver and executors
    are one process.  On a cluster without the setting this raises, because a folder on
    one machine would be lost with that machine.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    folder = spark.conf.get(_LOCAL_FALLBACK, None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="tallywork-")
        spark.conf.set(_LOCAL_FALLBACK, folder)
    return folder

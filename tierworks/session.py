"""One place that builds a session with the settings the library is tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.checkpoint.compress": "true",
    # Settled tables go once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Many small partitions to begin with; adaptive execution joins them to this size, but cannot split those of a window.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Keys of long watermarks live on local disk instead of the heap.
    STATE_STORE: ROCKS_DB,
}

#: On a cluster; 128 MB each of a shuffle of about 1 TB.
INITIAL_PARTITIONS = "8192"


def session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Build or get a session. Keyword names use ``__`` for dots: ``spark__ui__enabled="false"``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if not (master or "").startswith("local"):
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", INITIAL_PARTITIONS)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()

"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What a cluster session should set, besides what `shuffle_conf` gives for its size.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a later aggregation then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed state without a timeout outgrows executor heaps, so it lives in RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A micro-batch then uploads its changes instead of whole state files.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Reliable checkpoints of finished iterations are removed once their DataFrames are unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_conf(shuffled_bytes: int, cores: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Shuffle settings for a job that exchanges about ``shuffled_bytes`` on ``cores`` executor cores.

    The exchange starts with enough partitions that one fits in a task's memory, and at least two per core; AQE then
    merges what turns out small to the same size.
    """
    partitions = max(2 * cores, -(-shuffled_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def build_session(app_name: str = "skytally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword settings (dots as double underscores) win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = RECOMMENDED_CONF | {key.replace("__", "."): str(value) for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

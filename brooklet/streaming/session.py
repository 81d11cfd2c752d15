"""Session settings for streams that keep state."""

from __future__ import annotations

from pyspark.sql import SparkSession

STATE = "spark.sql.streaming.stateStore"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of its own for stateful streams.

    State lives in RocksDB, off the heap, and a batch checkpoints its changes only.
    The number of state partitions is fixed by the first run of a checkpoint; it
    follows the cores of the cluster unless given.
    """
    session = spark.newSession()
    session.conf.set(f"{STATE}.providerClass", ROCKSDB)
    session.conf.set(f"{STATE}.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.shuffle.partitions", partitions or spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session

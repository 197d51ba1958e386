"""Session settings of queries that keep keyed state."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import SparkSession

from salesloom.session import settings

# State on local disk with incremental snapshots in the checkpoint: it may exceed memory, and a batch
# reads and writes only the keys that it has.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def keyed_state(spark: SparkSession) -> AbstractContextManager[None]:
    """A query that starts inside keeps its state in RocksDB."""
    return settings(spark, ROCKSDB)

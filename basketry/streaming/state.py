"""Where streams keep their state."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_on_disk(spark: SparkSession, *, rewritten: bool) -> None:
    """Let streams started from now on keep their state in RocksDB, and of its commits two.

    State that each batch writes anew (``rewritten``) is compacted with each commit, which would
    otherwise hold the former values as well; state that keys are only added to has nothing to compact.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.compactOnCommit", str(rewritten).lower())
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")

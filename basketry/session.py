"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on.  Joins carry no broadcast hints: Spark
# broadcasts a side only when its own size estimate (file statistics, or the
# shuffle sizes AQE measures) is under spark.sql.autoBroadcastJoinThreshold, and
# AQE splits a partition that one hot key has blown up.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles begin with so many partitions whatever the cluster's default is, and AQE puts small
    # ones together: partitions of a large table stay small enough to be sorted without spilling.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "192",
    # A shuffled join whose smaller side has no partition above this is hashed, so the larger side
    # is neither sorted nor spilled.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle files go when the query that made them ends, not when the driver happens to collect
    # its garbage: what is on disk at a time is one step's shuffles, not those of all steps so far.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # HotSpot never compiles a method of more bytes: a stage whose generated code is larger would
    # be interpreted for all its rows, so Spark generates it operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "basketry", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="basketry-warehouse-"))
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session without
    that setting falls back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-shared-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str = "step", path: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder.

    Losing an executor costs nothing that has been written, later steps read only the
    columns they need, and Spark knows the size of the table when it plans a join.
    """
    path = path or fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def written_for(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows as `cut_lineage` gives them, for the steps of one block only: the table goes at its end."""
    path = fresh_path(df.sparkSession, name)
    try:
        yield cut_lineage(df, name, path)
    finally:
        remove(df.sparkSession, path)

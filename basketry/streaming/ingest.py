"""Raw ingest of JSON-lines files as they arrive."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from basketry.sources.readers import PATH_TABLES, RAW_SCHEMAS


def arriving_files(spark: SparkSession, bucket: str, prefix: str, *,
                   files_per_batch: int | None = None) -> DataFrame:
    """Rows of new ``.jsonl`` files below a prefix, compressed ones included; other files are not picked up.

    A line that is not JSON, or whose values do not fit the schema, fails the stream.
    """
    reader = (
        spark.readStream.schema(RAW_SCHEMAS[PATH_TABLES[prefix]])
        .option("pathGlobFilter", "*.{jsonl,jsonl.gz}").option("recursiveFileLookup", True).option("mode", "FAILFAST")
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(f"{bucket.rstrip('/')}/{prefix}")


def ingest_prefix(spark: SparkSession, bucket: str, prefix: str, target: str, checkpoint: str, *,
                  files_per_batch: int | None = None) -> StreamingQuery:
    """Append everything that has arrived to ``target`` and stop.

    The file sink commits each batch in its own log, so a batch that is run again after
    a failure is not added twice, and the checkpoint remembers which files are done.
    """
    return (
        arriving_files(spark, bucket, prefix, files_per_batch=files_per_batch)
        .writeStream.format("parquet").option("compression", "zstd").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def ingest_all(spark: SparkSession, bucket: str, target_root: str, checkpoint_root: str,
               **options) -> dict[str, int]:
    """One stream per prefix; returns the rows added per raw table.

    A failing stream raises here and stops the others; the next call takes up the same
    files again.
    """
    before = {t: table_rows(spark, f"{target_root}/{t}") for t in PATH_TABLES.values()}
    running = [
        ingest_prefix(spark, bucket, prefix, f"{target_root}/{table}",
                      f"{checkpoint_root}/{table}", **options)
        for prefix, table in PATH_TABLES.items()
    ]
    try:
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()
    return {t: table_rows(spark, f"{target_root}/{t}") - n for t, n in before.items()}


def table_rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet folder, 0 before its first file; answered from file footers."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0

"""Helpers the corpus operators share: words, folds, scratch tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import fresh_path, tune

# A word is a run of anything but the six ASCII white-space characters; `bytes.split()` cuts
# UTF-8 text at exactly the same places.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the corpus jobs: small Arrow batches, as single texts can be long."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "400")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text."""
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text modulo a number; -1 for a null key, which so is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(-1))


def keep(df: DataFrame, name: str) -> DataFrame:
    """The rows as a compressed table in the shared folder, so that no executor holds the only copy."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: Iterable[str | None]) -> Iterator[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    for text in column:
        yield text.encode("utf-8", "replace") if text else b""

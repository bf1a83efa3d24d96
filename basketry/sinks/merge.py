"""Upsert into tables without row-level updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.operators.quality import schema_differences
from basketry.session import cut_lineage
from basketry.sinks.writers import layer_table, save_table, table_or_none


DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class SchemaChanged(ValueError):
    """The batch does not have the columns of the table it should be merged into."""


def merge_by_key(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch replace target rows with equal keys; all others stay.

    A null key equals nothing: such target rows stay and such batch rows are added.
    """
    differences = schema_differences(batch, target.schema)
    if differences:
        raise SchemaChanged("; ".join(differences))
    incoming = batch.select(*keys).dropDuplicates(keys)
    kept = target.join(incoming, keys, "left_anti").select(*target.columns)
    return kept.unionByName(batch)


def merge_into_table(batch: DataFrame, layer: str, table: str, keys: list[str], *,
                     path: str | None = None) -> str:
    """Merge into a table, or create it; ``path`` is a new folder for the merged rows.

    The merged rows are written beside the table and take its name at the end.  Should
    the run stop between the two renames, the next one first puts the old table back.
    """
    spark = batch.sparkSession
    name = layer_table(layer, table)
    target = table_or_none(spark, name)
    if target is None and spark.catalog.tableExists(f"{name}__old"):
        spark.sql(f"ALTER TABLE {name}__old RENAME TO {name}")
        target = spark.table(name)
    if target is None:
        return save_table(batch, layer, table, path=path)
    save_table(merge_by_key(target, batch, keys), layer, f"{table}__next", path=path)
    spark.sql(f"DROP TABLE IF EXISTS {name}__old")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")
    spark.sql(f"DROP TABLE {name}__old")
    return name


def merge_into_partitions(batch: DataFrame, path: str, keys: list[str], partition: str) -> list:
    """Merge into a partitioned Parquet folder, rewriting touched partitions only.

    Touched are the partitions the batch writes to, and those that hold a row it
    replaces.  Both come from a distinct over the partition column, one value a day; a
    null value is a partition like any other.
    The new rows are written to the shared folder before anything is overwritten.
    """
    spark = batch.sparkSession
    batch = cut_lineage(batch)
    target = spark.read.parquet(path)
    # Spark guesses the type of a partition column from the folder names.
    target = target.withColumn(partition, F.col(partition).cast(batch.schema[partition].dataType))
    differences = schema_differences(batch, target.schema)
    if differences:
        raise SchemaChanged("; ".join(differences))

    incoming = batch.select(*keys).dropDuplicates(keys)
    replaced = target.join(incoming, keys, "left_semi").select(partition)
    touched = [
        r[0] for r in
        replaced.unionByName(batch.select(partition)).distinct().orderBy(partition).collect()
    ]
    if not touched:
        return touched

    here = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:  # rows without a partition value share one folder
        here = F.coalesce(here, F.lit(False)) | F.col(partition).isNull()
    current = target.where(here)
    merged = cut_lineage(merge_by_key(current, batch, keys))
    filled = {r[0] for r in merged.select(partition).distinct().collect()}
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition).parquet(path))
    for value in touched:
        if value not in filled:  # every row moved elsewhere: leave the partition empty
            folder = DEFAULT_PARTITION if value is None else value
            (merged.where(F.lit(False)).drop(partition)
                   .write.mode("overwrite").parquet(f"{path}/{partition}={folder}"))
    return touched


def merge_into_partitioned_table(batch: DataFrame, layer: str, table: str, keys: list[str], partition: str) -> str:
    """Merge into a table partitioned by one column, or create it; untouched partitions stay."""
    spark = batch.sparkSession
    name = layer_table(layer, table)
    if table_or_none(spark, name) is None:
        return save_table(batch, layer, table, partition_by=[partition])
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if partitions != [partition]:
        raise ValueError(f"{name} is partitioned by {partitions}, not by {partition}")
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    merge_into_partitions(batch, location, keys, partition)
    spark.catalog.recoverPartitions(name)  # days that are new to the table
    spark.catalog.refreshTable(name)
    return name

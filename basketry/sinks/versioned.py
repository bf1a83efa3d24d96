"""Tables of immutable partition versions with a commit log.

A write puts its partitions into a folder of its own and then adds one commit, a small file
that names the folder of every partition of the table.  The highest commit is the table: it
appears by one rename, so a reader sees all of a write or nothing of it, a run that stops on
the way leaves only a folder nobody refers to, and of two writers that began from the same
commit one fails.  Older commits stay readable until `vacuum`.

A commit has one entry for each partition, so it grows with the days of a table, not its rows.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.operators.quality import schema_differences
from basketry.session import written_for
from basketry.sinks.merge import DEFAULT_PARTITION, SchemaChanged, merge_by_key

VERSION = "__version"


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since this one read the table; run it again."""


@dataclass(frozen=True)
class Snapshot:
    """A commit: its number, the table's schema and the folder of each partition (None: null)."""

    number: int
    schema: T.StructType
    folders: dict[str | None, str]


class VersionedTable:
    """A table below ``root``, partitioned by one column."""

    def __init__(self, spark: SparkSession, root: str, partition: str):
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.root).getFileSystem(conf)
        place = self._files.makeQualified(self._path(self.root)).toUri()
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place, conf)
        self._rename = jvm.org.apache.hadoop.fs.Options.Rename

    # ---- commits ----

    def versions(self) -> list[int]:
        """Numbers of the commits that can be read, oldest first."""
        folder = self._path(f"{self.root}/_commits")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """A commit, the last one by default; None if nothing has been committed."""
        known = self.versions()
        if not known:
            return None
        number = known[-1] if version is None else version
        lines = self.spark.read.option("wholetext", True).text(self._commit_path(number)).first()
        if lines is None:
            raise ValueError(f"{self.root} has no commit {number}")
        content = json.loads(lines[0])
        return Snapshot(number, T.StructType.fromJson(content["schema"]), {e["value"]: e["folder"] for e in content["partitions"]})

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/_commits/{number:020d}.json"

    def _commit(self, base: Snapshot | None, schema: T.StructType, folders: dict[str | None, str]) -> int:
        """Add the commit after ``base`` under its final name, in one step."""
        number = 1 if base is None else base.number + 1
        content = json.dumps({"schema": schema.jsonValue(),
                              "partitions": [{"value": v, "folder": folders[v]} for v in sorted(folders, key=lambda v: (v is None, v or ""))]})
        waiting = self._path(f"{self.root}/_commits/.{uuid.uuid4().hex}")
        stream = self._files.create(waiting, False)
        stream.write(bytearray(content.encode()))
        stream.close()
        once = self.spark.sparkContext._gateway.new_array(self._rename, 1)
        once[0] = self._rename.NONE  # fails where the name is taken
        try:
            self._context.rename(waiting, self._path(self._commit_path(number)), once)
        except Exception as error:
            self._files.delete(waiting, False)
            if self._files.exists(self._path(self._commit_path(number))):
                raise ConcurrentCommit(f"commit {number} of {self.root} was made by another writer") from error
            raise
        return number

    # ---- reading ----

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a commit.  Filters on the partition column prune folders."""
        found = self.snapshot(version)
        if found is None:
            raise ValueError(f"{self.root} has not been written yet")
        return self._rows(found, list(found.folders))

    def _rows(self, found: Snapshot, values: list[str | None]) -> DataFrame:
        names = [f.name for f in found.schema]
        if not values:
            return self.spark.createDataFrame([], found.schema)
        plain = [f for f in found.schema if f.name != self.partition]
        kinds = [T.StructField(VERSION, T.StringType()), found.schema[self.partition]]
        read = self.spark.read.schema(T.StructType([*plain, *kinds])).option("basePath", f"{self.root}/data")
        with self._listing_in_few_tasks():
            return read.parquet(*[f"{self.root}/data/{found.folders[v]}" for v in values]).select(*names)

    @contextlib.contextmanager
    def _listing_in_few_tasks(self) -> Iterator[None]:
        """Folders are listed by a job, by default with a task for each; some per core do."""
        name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, str(4 * self.spark.sparkContext.defaultParallelism))
        try:
            yield
        finally:
            self.spark.conf.set(name, before)

    # ---- writing ----

    def _write(self, df: DataFrame) -> dict[str | None, str]:
        """Rows into new version folders; returns the folder of each partition that has rows."""
        version = f"{VERSION}={uuid.uuid4().hex}"
        target = f"{self.root}/data/{version}"
        # Rows of a day meet, so that a day is one file or few; AQE splits a day that is too large.
        df.hint("rebalance", F.col(self.partition)).write.option("compression", "zstd").partitionBy(self.partition).parquet(target)
        made = {}
        for status in self._files.listStatus(self._path(target)):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(f"{self.partition}="):
                value = name.split("=", 1)[1]
                made[None if value == DEFAULT_PARTITION else unquote(value)] = f"{version}/{name}"
        return made

    def replace(self, df: DataFrame) -> int:
        """Replace the whole table; returns the commit."""
        return self._commit(self.snapshot(), df.schema, self._write(df))

    def append(self, df: DataFrame, base: Snapshot | None) -> int | None:
        """Add partitions that ``base`` does not have, as the commit after it; None without rows.

        Whoever decided on the rows by reading ``base`` learns by `ConcurrentCommit` that it is
        no longer the table.
        """
        if base is not None:
            self._same_columns(df, base)
            df = df.select(*[f.name for f in base.schema])
        made = self._write(df)
        if not made:
            return None
        known = {} if base is None else base.folders
        taken = sorted(set(made) & set(known), key=str)
        if taken:
            raise ValueError(f"partitions that are there already: {self.partition} {taken[:3]}")
        return self._commit(base, df.schema if base is None else base.schema, known | made)

    def replace_where(self, df: DataFrame, condition: Column) -> int:
        """Replace the partitions for whose value the condition holds by the rows of df.

        Rows of df outside these partitions would be lost or mixed in, so they are refused.
        """
        base = self.snapshot()
        if base is None:
            return self.replace(df)
        self._same_columns(df, base)
        values = self._values(base, condition)
        made = self._write(df.select(*[f.name for f in base.schema]))
        strangers = sorted(set(made) - self._values(base, condition, list(made)), key=str)
        if strangers:
            raise ValueError(f"rows outside the partitions to replace: {self.partition} {strangers[:3]}")
        kept = {v: folder for v, folder in base.folders.items() if v not in values}
        return self._commit(base, base.schema, kept | made)

    def _values(self, base: Snapshot, condition: Column, values: list[str | None] | None = None) -> set[str | None]:
        """Those of the partition values for which a condition on the partition column holds."""
        values = list(base.folders) if values is None else values
        kind = base.schema[self.partition].dataType
        listed = self.spark.createDataFrame(pa.table({"__text": pa.array(values, pa.string())}))
        return {r[0] for r in listed.withColumn(self.partition, F.col("__text").cast(kind)).where(condition).select("__text").collect()}

    def _same_columns(self, df: DataFrame, base: Snapshot) -> None:
        differences = schema_differences(df, base.schema)
        if differences:
            raise SchemaChanged("; ".join(differences))

    def merge(self, batch: DataFrame, keys: list[str]) -> list[str | None]:
        """Rows of the batch replace rows with equal keys; returns the partitions rewritten.

        Rewritten are the partitions the batch writes to and those that hold a row it replaces,
        both from a distinct over the partition column.  A row that moves from one partition to
        another leaves the first and enters the second with the same commit.
        """
        base = self.snapshot()
        if base is None:
            raise ValueError(f"{self.root} has not been written yet")
        self._same_columns(batch, base)
        with written_for(batch, "batch") as batch:
            everything = self._rows(base, list(base.folders))
            text = F.col(self.partition).cast("string").alias("value")
            replaced = everything.join(batch.select(*keys).dropDuplicates(keys), keys, "left_semi").select(text)
            touched = sorted((r[0] for r in replaced.union(batch.select(text)).distinct().collect()), key=lambda v: (v is None, v or ""))
            if not touched:
                return touched
            current = self._rows(base, [v for v in touched if v in base.folders])
            made = self._write(merge_by_key(current, batch, keys).select(*[f.name for f in base.schema]))
        kept = {v: folder for v, folder in base.folders.items() if v not in touched}
        self._commit(base, base.schema, kept | made)
        return touched

    # ---- upkeep ----

    def publish(self, name: str) -> str:
        """Give the last commit a table name in the catalog.

        The table is made beside the old one, refers to the same files, and takes its name at
        the end; no data moves.
        """
        spark, found = self.spark, self.snapshot()
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        order = [f for f in found.schema if f.name != self.partition] + [found.schema[self.partition]]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in order)
        spark.sql(f"DROP TABLE IF EXISTS {name}__next")
        spark.sql(f"CREATE TABLE {name}__next ({columns}) USING parquet PARTITIONED BY (`{self.partition}`) LOCATION '{self.root}/data'")
        places = []
        for value, folder in found.folders.items():
            literal = "null" if value is None else "'" + value.replace("'", "\\'") + "'"
            places.append(f"PARTITION (`{self.partition}` = {literal}) LOCATION '{self.root}/data/{folder}'")
        if places:
            spark.sql(f"ALTER TABLE {name}__next ADD " + " ".join(places))
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")
        return name

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove commits but the last ``keep``, and version folders no commit left names.

        Not to be run beside a writer: its folder is named by no commit yet.
        """
        known = self.versions()
        stay = known[-keep:] if keep > 0 else known[-1:]
        used = {folder.split("/")[0] for n in stay for folder in self.snapshot(n).folders.values()}
        for number in known[:-len(stay)] if stay else []:
            self._files.delete(self._path(self._commit_path(number)), False)
        data = self._path(f"{self.root}/data")
        removed = []
        if self._files.exists(data):
            for status in self._files.listStatus(data):
                folder = status.getPath().getName()
                if folder.startswith(f"{VERSION}=") and folder not in used:
                    self._files.delete(status.getPath(), True)
                    removed.append(folder)
        return sorted(removed)

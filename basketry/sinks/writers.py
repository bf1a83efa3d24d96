"""File and table writers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from basketry.functions.dates import iso_text

MAX_DOCUMENTS_PER_FILE = 500_000


def export_jsonl(df: DataFrame, path: str, *, limit: int | None = None,
                 max_per_file: int = MAX_DOCUMENTS_PER_FILE, compression: str = "gzip") -> None:
    """JSON-lines parts of at most ``max_per_file`` documents each; instants as ISO-8601 text.

    Every document names all its fields, so plain text is many times the size of its content;
    Spark's readers tell by the ending whether a part is compressed.
    """
    df = df.select(*[
        iso_text(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])
    if limit is not None:
        df = df.limit(limit)
    (df.write.option("maxRecordsPerFile", max_per_file)
       .option("ignoreNullFields", False).option("compression", compression).mode("errorifexists").json(path))


def export_all(tables: dict[str, DataFrame], root: str, **options) -> dict[str, str]:
    """Every named table to its own prefix; returns the prefixes."""
    paths = {name: f"{root.rstrip('/')}/raw/{name}" for name in tables}
    for name, df in tables.items():
        export_jsonl(df, paths[name], **options)
    return paths


@dataclass(frozen=True)
class LoadStats:
    added: int
    total: int


def append_rows(df: DataFrame, path: str) -> LoadStats:
    """Append to a Parquet table; rows added are counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("added")).write.mode("append").parquet(path)
    return LoadStats(seen.get["added"], df.sparkSession.read.parquet(path).count())


def replace_rows(df: DataFrame, path: str) -> None:
    """Replace the content of a Parquet table; running it twice changes nothing."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """CSV with header; a fixed column list keeps the header even without rows.

    Blanks at the ends of values are kept, which Spark's writer does not do by itself.
    """
    out = df.select(*columns) if columns else df
    (out.write.mode("overwrite").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def split_rows(df: DataFrame, failed: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad); a null test counts as good."""
    bad = F.coalesce(failed, F.lit(False))
    return df.where(~bad), df.where(bad)


def write_quarantine(errors: DataFrame, path: str, columns: list[str]) -> bool:
    """Write rejected rows only if there are any."""
    if errors.isEmpty():
        return False
    write_csv(errors, path, columns)
    return True


def layer_table(layer: str | None, table: str, default: str = "default") -> str:
    """Qualified table name; without a layer the default database is used."""
    database = default if layer is None else layer.strip()
    return f"{database}.{table}"


def save_table(df: DataFrame, layer: str | None, table: str, *,
               partition_by: list[str] | None = None, path: str | None = None) -> str:
    """Replace a table in the database of its layer.

    Without a ``path`` the table is managed and lies in the warehouse folder.
    """
    name = layer_table(layer, table)
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def publish_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def markdown_table(df: DataFrame, *, limit: int = 1000) -> str:
    """A small report as Markdown; raises if it has more than ``limit`` rows."""
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"a report of more than {limit} rows; write it as a table")
    head = "| " + " | ".join(df.columns) + " |"
    rule = "|" + "---|" * len(df.columns)
    body = ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]
    return "\n".join([head, rule, *body])

"""File readers and the registry of named inputs."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.sources import schemas


def read_events(spark: SparkSession, path: str, *, option_type: T.DataType | None = None) -> DataFrame:
    """Event documents, one JSON object per line.

    The declared schema drops unknown fields; a line that is not JSON, or holds a value
    of the wrong type, fails the read instead of losing data.
    """
    schema = schemas.event_schema(option_type)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product documents; every column is text."""
    return spark.read.schema(schemas.PRODUCTS).option("mode", "FAILFAST").json(path)


def read_ip_locations(spark: SparkSession, path: str) -> DataFrame:
    """IP locations with an inferred schema; every scalar ends up as text."""
    df = spark.read.option("primitivesAsString", True).json(path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def read_currency_rates(spark: SparkSession, path: str) -> DataFrame:
    """Currency seed from a CSV with header; blanks inside symbols are kept."""
    return spark.read.schema(schemas.CURRENCY_RATES).option("header", True).csv(path)


def bundled_rate_rows() -> list[tuple[str, str, str, float]]:
    """The 35 seed rows shipped with the package."""
    source = resources.files("basketry.sources") / "data" / "currency_rates.csv"
    with source.open(encoding="utf-8", newline="") as lines:
        return [
            (r["currency_symbol"], r["currency_code"], r["currency_name"], float(r["rate_to_usd"]))
            for r in csv.DictReader(lines)
        ]


def bundled_currency_rates(spark: SparkSession) -> DataFrame:
    """The bundled seed as literals in the plan, so executors need no local file."""
    rows = ", ".join(
        "(" + ", ".join("'" + text.replace("'", "''") + "'" for text in row[:3]) + f", {row[3]!r}D)"
        for row in bundled_rate_rows()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rates({', '.join(schemas.CURRENCY_RATES.names)})")


def read_product_urls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRODUCT_URLS).option("header", True).csv(path)


def read_done_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct product ids of an output that may end in a torn line."""
    return (
        spark.read.schema("product_id string").option("mode", "DROPMALFORMED").json(path)
        .where(F.col("product_id").isNotNull())
        .distinct()
    )


def describe_columns(df: DataFrame) -> DataFrame:
    """Catalog view of a table: position, name, type, nullable, one row per column."""
    rows = [
        F.struct(
            F.lit(i).alias("ordinal_position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit("YES" if f.nullable else "NO").alias("is_nullable"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return (
        df.sparkSession.range(1).select(F.inline(F.array(*rows))).orderBy("ordinal_position")
    )


# Path prefix of an incoming file -> raw table it belongs to.
PATH_TABLES = {
    "raw/summary/": "raw_summary",
    "raw/ip_location/": "raw_ip_location",
    "raw/products/": "raw_products",
}

ENDINGS = (".jsonl", ".jsonl.gz")

RAW_SCHEMAS = {
    "raw_summary": schemas.EVENTS,
    "raw_ip_location": schemas.IP_LOCATIONS,
    "raw_products": schemas.PRODUCTS,
}


def table_for_path(name: str) -> str | None:
    """Raw table for a file path relative to the bucket; None means: skip the file."""
    if not name.endswith(ENDINGS):
        return None
    return next((t for prefix, t in PATH_TABLES.items() if name.startswith(prefix)), None)


def route_column(path: str = "_metadata.file_path", root: str = "") -> Column:
    """The same routing as a Column, for listings held in a DataFrame."""
    name = F.regexp_replace(F.col(path), "^" + re.escape(root), "")
    route = F.lit(None).cast("string")
    for prefix, table in PATH_TABLES.items():
        fits = name.endswith(ENDINGS[0]) | name.endswith(ENDINGS[1])
        route = F.when(name.startswith(prefix) & fits, table).otherwise(route)
    return route


class Registry:
    """Named DataFrames: sources by table name, models by the function that builds them.

    A model is built when it is first referred to, and once.
    """

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark = spark
        self.database = database
        self._builders: dict[str, Callable[[], DataFrame]] = {}
        self._built: dict[str, DataFrame] = {}

    def add(self, name: str, build: Callable[[], DataFrame]) -> None:
        self._builders[name] = build

    def put(self, name: str, df: DataFrame) -> None:
        """Let later references see ``df``, such as the table a model was saved to."""
        self._built[name] = df

    def source(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{table}" if self.database else table)

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    __getitem__ = ref

"""Column profiles: exact ones in one pass, and sketches per load that add up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketry.functions.numbers import share_percent, to_long

SKETCH_BITS = 14  # registers of a sketch, as a power of two: about 0.8 % error


def comparable(df: DataFrame, name: str) -> Column:
    """A column as text that is equal just where its values are."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0.0)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.to_json(column)
    return column.cast("string")


def profile_columns(df: DataFrame, columns: list[str], *, approximate: bool = False) -> DataFrame:
    """(field, total, null_count, null_percent, distinct_count), one row per column.

    All columns are profiled in one scan.  Exact counts turn a row into (field, value) pairs
    that are counted map-side before the shuffle, so a value costs one pair per map task
    however often it occurs; ``approximate`` keeps to a fixed-size sketch per column.
    """
    if approximate:
        return described(_sketched(df, columns, lambda c: F.approx_count_distinct(c)).withColumnRenamed("sketch", "distinct_count"))
    pairs = [F.struct(F.lit(name).alias("field"), comparable(df, name).alias("value")) for name in columns]
    values = df.select(F.inline(F.array(*pairs))).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = values.groupBy("field").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("distinct_count"))
    fields = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("field"))
    zero = F.lit(0).cast("bigint")
    return described(fields.join(counted, "field", "left").select(
        "field", *[F.coalesce(c, zero).alias(c) for c in ("total", "null_count", "distinct_count")]))


def described(counts: DataFrame) -> DataFrame:
    """Counts with the share of nulls."""
    return counts.select("field", "total", "null_count", F.round(share_percent("null_count", "total"), 2).alias("null_percent"),
                         "distinct_count")


def _sketched(df: DataFrame, columns: list[str], sketch) -> DataFrame:
    """(field, total, null_count, sketch), from one aggregate over the table."""
    counts = [F.count(F.lit(1)).alias("total")]
    for i, name in enumerate(columns):
        counts += [F.count_if(F.col(f"`{name}`").isNull()).alias(f"n{i}"), sketch(comparable(df, name)).alias(f"d{i}")]
    rows = [F.struct(F.lit(name).alias("field"), F.col(f"n{i}").alias("null_count"), F.col(f"d{i}").alias("sketch"))
            for i, name in enumerate(columns)]
    return df.agg(*counts).select("total", F.inline(F.array(*rows))).select("field", "total", "null_count", "sketch")


def write_load_sketches(df: DataFrame, columns: list[str], path: str, load: str) -> None:
    """Keep the sketches of one load beside its table; a load that is repeated replaces its own."""
    made = _sketched(df, columns, lambda c: F.hll_sketch_agg(c, F.lit(SKETCH_BITS)))
    made.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/load={load}")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Profile of all loads from their sketches: no row of the table is read again."""
    return described(sketches.groupBy("field").agg(
        F.sum("total").alias("total"), F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count")))


def count_uncastable(df: DataFrame, column: str) -> DataFrame:
    """How many values are present but not whole numbers, as (invalid_count)."""
    broken = F.col(column).isNotNull() & to_long(F.col(column).cast("string")).isNull()
    return df.agg(F.count_if(broken).alias("invalid_count"))


def profile_tables(tables: dict[str, tuple[DataFrame, list[str]]], **options) -> DataFrame:
    """Profiles of several tables, with the table name in front."""
    parts = [
        profile_columns(df, columns, **options).select(F.lit(name).alias("table_name"), "*")
        for name, (df, columns) in tables.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionAll(part)
    return report

"""Choosing rows per key.

Spark plans a row number that is filtered to ``<= n`` with a group limit before the
shuffle: every map task forwards at most n rows of a key, so a key that holds a third
of the table costs its reducer n rows per map task and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.text import as_column

_RANK = "__rank"


def first_n_per_key(df: DataFrame, keys: list[str | Column], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key; ``order`` must be total for a repeatable result."""
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, ranked).where(F.col(_RANK) <= n).drop(_RANK)


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    return first_n_per_key(df, keys, order, 1)


def earliest_value(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """One value per key: the one that comes first in ``order``."""
    return df.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))


def latest_value(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def most_frequent(df: DataFrame, value: str | Column, n: int, *, name: str) -> DataFrame:
    """Top n values by count; equal counts go by value."""
    return (
        df.groupBy(as_column(value).alias(name)).agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc(name)).limit(n)
    )


def ranked_values(counts: DataFrame, value: str) -> DataFrame:
    """One row with the values of a counted top-n list as an array, best first."""
    pairs = F.sort_array(F.collect_list(F.struct((-F.col("cnt")).alias("order"), F.col(value))))
    return counts.agg(F.transform(pairs, lambda p: p[value]).alias("ranked"))

"""Joins against lookups and between key sets.

No join is hinted.  A lookup is broadcast only where its measured size allows it; any
other join is shuffled, and AQE splits the partitions a hot key makes too large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SHORT_LIST = 1000


def lookup(facts: DataFrame, table: DataFrame, on: str, *, table_key: str | None = None) -> DataFrame:
    """Left equi-join that adds the columns of ``table``; null keys match nothing.

    The key column of ``table`` itself is not added.
    """
    key = table_key or on
    side = table.withColumnRenamed(key, "__key")
    return facts.join(side, facts[on] == F.col("__key"), "left").drop("__key")


def missing_keys(keys: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct non-null keys without a counterpart in ``known``."""
    wanted = keys.select(column).where(F.col(column).isNotNull()).distinct()
    return wanted.join(known.select(column), column, "left_anti")


def rows_with_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is in the key set, each at most once."""
    return df.join(keys.select(column), column, "left_semi")


def remaining_tasks(tasks: DataFrame, done: DataFrame, column: str) -> DataFrame:
    """Tasks that have no entry among the finished ones."""
    return tasks.join(done.select(column), column, "left_anti")


def first_source_wins(preferred: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """Union of two keyed tables; where both know a key, the first one counts."""
    return preferred.unionByName(fallback.join(preferred.select(key), key, "left_anti"))


def best_source(sources: list[DataFrame], key: str) -> DataFrame:
    """One row per key, from the first of the sources that knows it.

    Every source is read once and rows are combined map-side before the one shuffle, so a
    source may repeat keys; of rows of one source the least by its other columns counts.  A
    null key is a key like any other.
    """
    columns = sources[0].columns
    others = [c for c in columns if c != key]
    ranked = [df.select(*columns, F.lit(n).alias("__rank")) for n, df in enumerate(sources)]
    best = reduce(DataFrame.unionAll, ranked).groupBy(key).agg(F.min(F.struct("__rank", *others)).alias("__best"))
    return best.select(*[F.col(c) if c == key else F.col(f"__best.{c}").alias(c) for c in columns])


def every_pair(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Each row with each item of a short list.

    The list travels as one array value, such as ISO currency codes, so rows are multiplied in
    place and nothing is shuffled.  A list of more than ``SHORT_LIST`` items fails the query.
    """
    packed = items.limit(SHORT_LIST + 1).agg(F.collect_list(F.struct(*items.columns)).alias("items"))
    too_long = F.raise_error(F.lit(f"a list of more than {SHORT_LIST} items"))
    checked = packed.select(F.when(F.size("items") > SHORT_LIST, too_long).otherwise(F.col("items")).alias("items"))
    return rows.select("*", F.inline(checked.scalar()))


def with_row(df: DataFrame, **values: Column | object) -> DataFrame:
    """Append one literal row; columns that are not named are null."""
    row = [
        (values[f.name] if isinstance(values.get(f.name), Column) else F.lit(values.get(f.name)))
        .cast(f.dataType).alias(f.name)
        for f in df.schema.fields
    ]
    return df.unionByName(df.sparkSession.range(1).select(*row))

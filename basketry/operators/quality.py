"""Data tests.  Each returns the rows that break the rule; no rows means it holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketry.sources.schemas import contract


# Conditions that a broken row fulfils; null values break nothing but ``is_missing``.

def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_unexpected(column: str, values: Iterable) -> Column:
    return ~F.col(column).isin(list(values))


def is_outside(column: str, low=None, high=None, *, strictly: bool = False) -> Column:
    """Outside the bounds, which belong to the range unless ``strictly``."""
    value, broken = F.col(column), F.lit(False)
    if low is not None:
        broken = broken | ((value <= low) if strictly else (value < low))
    if high is not None:
        broken = broken | ((value >= high) if strictly else (value > high))
    return broken


def is_unlike(column: str, pattern: str) -> Column:
    return ~F.col(column).rlike(pattern)


def has_other_length(column: str, length: int) -> Column:
    return F.length(column) != length


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_missing(column))


def unique(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; rows with a null key pass."""
    columns = [columns] if isinstance(columns, str) else columns
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return duplicate_keys(df, columns)


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once; null counts as a value."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def accepted_values(df: DataFrame, column: str, values: Iterable, *, where: str | None = None) -> DataFrame:
    return _scope(df, where).where(is_unexpected(column, values))


def relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key is not in the parent; null keys pass."""
    keys = parent.select(F.col(parent_column).alias("__parent"))
    return (
        child.where(F.col(column).isNotNull())
        .join(keys, F.col(column) == F.col("__parent"), "left_anti")
    )


def between(df: DataFrame, column: str, low=None, high=None, *, strictly: bool = False,
            where: str | None = None) -> DataFrame:
    return _scope(df, where).where(is_outside(column, low, high, strictly=strictly))


def matches(df: DataFrame, column: str, pattern: str, *, where: str | None = None) -> DataFrame:
    return _scope(df, where).where(is_unlike(column, pattern))


def length_is(df: DataFrame, column: str, length: int, *, where: str | None = None) -> DataFrame:
    return _scope(df, where).where(has_other_length(column, length))


def row_count_between(df: DataFrame, low: int, high: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).where(
        (F.col("row_count") < low) | (F.col("row_count") > high)
    )


def same_row_count(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """One row with both counts if they differ.  Counted side by side in one aggregate."""
    tagged = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return tagged.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias(left_name),
        F.coalesce(F.sum("r"), F.lit(0)).alias(right_name),
    ).where(F.col(left_name) != F.col(right_name))


def _scope(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where else df


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """What is missing, unexpected or of another type; column order does not matter."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    return (
        [f"missing column {n}" for n in want if n not in have]
        + [f"unexpected column {n}" for n in have if n not in want]
        + [
            f"column {n} is {have[n].simpleString()}, not {want[n].simpleString()}"
            for n in want if n in have and have[n] != want[n]
        ]
    )


class ContractBroken(ValueError):
    """A model does not have the columns it promises."""


def enforce_contract(df: DataFrame, table: str) -> DataFrame:
    """Fail unless names and types fit the contract; columns come out in its order."""
    expected = contract(table)
    differences = schema_differences(df, expected)
    if differences:
        raise ContractBroken(f"{table}: " + "; ".join(differences))
    return df.select(*expected.names)


def count_broken(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(check, failures) of any number of row conditions, from one pass over the table."""
    names = list(conditions)
    counts = df.agg(*[F.count_if(conditions[name]).alias(f"f{i}") for i, name in enumerate(names)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(f"f{i}").alias("failures"))
        for i, name in enumerate(names)
    ])))


def count_rows(checks: dict[str, DataFrame]) -> list[DataFrame]:
    """(check, failures) per test that yields its offending rows."""
    return [
        rows.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures")
        for name, rows in checks.items()
    ]


def one_report(parts: list[DataFrame]) -> DataFrame:
    report = parts[0]
    for part in parts[1:]:
        report = report.unionAll(part)
    return report

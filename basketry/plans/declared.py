"""The declared data tests of the warehouse, as data: one row each in ``declared_tests.csv``.

Tests are built from the rows, measured, and joined to the rows again, so that a test that was
not run, or that has no rule, shows as such instead of going missing.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.operators import quality as q

RUN_OK, RUN_FAILED, NOT_RUN = "ok", "failed", "not run"


@dataclass(frozen=True)
class Declared:
    model: str
    columns: tuple[str, ...]
    kind: str
    low: float | None  # bound, length or least number of rows
    high: float | None
    other: str  # parent table, values or pattern
    scope: str  # rows the test looks at; empty: all

    @property
    def name(self) -> str:
        named = {
            "above": f"{self.model}.{self.columns[0]} above {self.low:g}" if self.kind == "above" else "",
            "in": f"{self.model}.{self.columns[0]} in {self.other}",
            "place unique": f"{self.model} place unique",
            "row count": "fact row count",
            "same rows": "mart has the rows of the fact",
            "no duplicate order and product": self.kind,
        }
        return named.get(self.kind, f"{self.model}.{self.columns[0]} {self.kind}")

    def condition(self) -> Column | None:
        """What a broken row fulfils; None for tests that need more than the row."""
        column = self.columns[0]
        made = {
            "not null": lambda: q.is_missing(column),
            "between": lambda: q.is_outside(column, self.low, self.high),
            "above": lambda: q.is_outside(column, self.low, strictly=True),
            "accepted": lambda: q.is_unexpected(column, self.other.split("|")),
            "hashed": lambda: q.is_unlike(column, self.other),
            "length": lambda: q.has_other_length(column, int(self.low)),
        }.get(self.kind)
        if made is None:
            return None
        return F.expr(self.scope) & made() if self.scope else made()

    def broken_rows(self, tables: dict[str, DataFrame]) -> DataFrame | None:
        """The offending rows, keys or counts of the tests that look at whole tables."""
        df, columns = tables[self.model], list(self.columns)
        if self.kind == "unique":
            return q.unique(df, columns)
        if self.kind in ("place unique", "no duplicate order and product"):
            return q.duplicate_keys(df, columns)
        if self.kind == "in":
            return q.relationship(df, columns[0], tables[self.other], columns[0])
        if self.kind == "row count":
            return q.row_count_between(df, int(self.low), int(self.high))
        if self.kind == "same rows":
            return q.same_row_count(tables[self.other], df, "other_count", "row_count")
        return None


def catalogue() -> list[Declared]:
    def number(text: str) -> float | None:
        return float(text) if text else None

    source = resources.files("basketry.sources") / "data" / "declared_tests.csv"
    with source.open(encoding="utf-8", newline="") as lines:
        return [Declared(r["model"], tuple(r["column"].split("|")), r["kind"], number(r["low"]), number(r["high"]),
                         r["other"], r["scope"]) for r in csv.DictReader(lines)]


def columns_read(tests: list[Declared], model: str, columns: list[str]) -> list[str]:
    """Those of a model's columns that its tests look at, or name in their scope."""
    own = [t for t in tests if t.model == model]
    return [c for c in columns if any(c in t.columns or re.search(rf"\b{re.escape(c)}\b", t.scope) for t in own)]


def measure(tests: list[Declared], tables: dict[str, DataFrame]) -> DataFrame:
    """(check, failures) of the tests whose tables are there and whose kind has a rule.

    Conditions on single rows share one pass per table; keys, references and counts take one each.
    """
    conditions: dict[str, dict[str, Column]] = {}
    whole: dict[str, DataFrame] = {}
    for test in tests:
        needed = {test.model} | ({test.other} if test.kind in ("in", "same rows") else set())
        if not needed <= set(tables):
            continue
        condition = test.condition()
        if condition is not None:
            conditions.setdefault(test.model, {})[test.name] = condition
        elif (rows := test.broken_rows(tables)) is not None:
            whole[test.name] = rows
    return q.one_report([q.count_broken(tables[m], c) for m, c in conditions.items()] + q.count_rows(whole))


def with_outcome(spark: SparkSession, tests: list[Declared], measured: DataFrame) -> DataFrame:
    """(check, model, kind, failures, outcome) of every declared test; failures are null where it was not run."""
    rows = [(t.name, t.model, t.kind) for t in tests]
    names = ("check", "model", "kind")
    declared = spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows])))
    outcome = F.when(F.col("failures").isNull(), NOT_RUN).when(F.col("failures") > 0, RUN_FAILED).otherwise(RUN_OK)
    return declared.join(measured, "check", "left").withColumn("outcome", outcome)

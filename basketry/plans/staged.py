"""Staging kept by day, so that a run reads only the raw events of its look-back window.

Three tables with a commit log: the distinct cart lines by day, and how often stores show a
host and which currency symbols occur, by day within a month.  A full load writes all of
them.  A later load takes a window: the raw scan is pruned to it (`time_stamp` is compared
with a number, which every file format can push down), its days are parsed and replaced, and
older days stay as they are.

A line of the window whose order and product are already staged on an older day is a repeat
and is left out, as the whole history would leave it out.  Events without a time, and those
that arrive later than the window, come in with the next full load; so do lines that only
became distinct because an older one has gone.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.functions.dates import utc_date
from basketry.plans import staging
from basketry.session import written_for
from basketry.sinks.versioned import VersionedTable

DAY, MONTH = "order_date", "order_month"
LINE = ["order_id", "product_id"]
EPOCH = datetime.date(1970, 1, 1)


def since_day(events: DataFrame, since: datetime.date) -> DataFrame:
    """Raw events from the start of a UTC day on."""
    return events.where(F.col("time_stamp") >= F.lit((since - EPOCH).days * 86400).cast("bigint"))


def month_key(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


@dataclass
class StagedDays:
    lines: VersionedTable
    visits: VersionedTable
    symbols: VersionedTable

    @classmethod
    def below(cls, spark: SparkSession, root: str) -> StagedDays:
        return cls(VersionedTable(spark, f"{root}/cart_lines", DAY), VersionedTable(spark, f"{root}/store_visits", MONTH),
                   VersionedTable(spark, f"{root}/currency_symbols", MONTH))

    def exists(self) -> bool:
        return self.lines.exists() and self.visits.exists() and self.symbols.exists()

    def load(self, events: DataFrame, currency_rates: DataFrame, since: datetime.date | None = None) -> None:
        """Stage all events, or those from a day on in place of what was staged from that day on."""
        with written_for(staging.parsed_carts(events if since is None else since_day(events, since)), "carts") as window:
            lines = staging.checkout_cart_items(window, currency_rates, whole=True)
            if since is None:
                self.lines.replace(lines)
            else:
                with written_for(lines, "window") as lines:
                    self.lines.replace_where(self._not_staged_before(lines, since), F.col(DAY) >= F.lit(since))
            day = utc_date("time_stamp").alias(DAY)
            self._load_months(self.visits, staging.store_visits(window, day), since)
            self._load_months(self.symbols, staging.currency_symbols(window, day), since)

    def _not_staged_before(self, lines: DataFrame, since: datetime.date) -> DataFrame:
        """Lines (written, as they are read twice) whose key no older day holds; null keys are equal here, as in the choice of the first line.

        The older days are met with the few keys of the window, not the other way round, so the
        history is read by two columns and not shuffled while those keys are small.
        """
        keys = lines.select(*[F.col(c).alias(f"new_{c}") for c in LINE]).distinct()
        same = lambda a, b: F.col(f"{a}order_id").eqNullSafe(F.col(f"{b}order_id")) & F.col(f"{a}product_id").eqNullSafe(
            F.col(f"{b}product_id"))
        older = self.lines.read().where(F.col(DAY) < F.lit(since)).select(*LINE)
        known = older.join(keys, same("", "new_"), "left_semi").select(*[F.col(c).alias(f"old_{c}") for c in LINE]).distinct()
        return lines.join(known, same("", "old_"), "left_anti")

    def _load_months(self, table: VersionedTable, days: DataFrame, since: datetime.date | None) -> None:
        """Summaries of a window, with the days of its first month that lie before it."""
        made = days.withColumn(MONTH, month_key(F.col(DAY)))
        if since is None:
            table.replace(made)
            return
        first = since.year * 100 + since.month
        before = table.read().where((F.col(MONTH) == first) & (F.col(DAY) < F.lit(since)))
        table.replace_where(before.unionByName(made), F.col(MONTH) >= first)

    # ---- the staging models, from what is staged ----

    def cart(self) -> DataFrame:
        return self.lines.read()

    def store(self) -> DataFrame:
        return staging.stores(self.visits.read())

    def currency(self, currency_rates: DataFrame) -> DataFrame:
        return staging.currencies(self.symbols.read(), currency_rates)

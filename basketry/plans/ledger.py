"""Resumable work on stored pages: a ledger of attempts that decides what is tried next.

A row of the ledger is one attempt of a product on a domain, with its outcome and, if it went
well, the parsed product.  Products, failures and open work are all read from the ledger, so
none of them can disagree with another.  The attempts of a round are a partition of a versioned
table and appear by one commit: a run that stops on the way has tried nothing, a run that is
repeated finds its attempts made, and of two runs at once one fails with `ConcurrentCommit`.

A pass tries the planned domains of a product in order until one yields it; ``new_pass`` tries
the failed products once more.  A task whose page is not stored yet stays open.  Pages
without a product id, and of domains that are not planned next, are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.operators import pages
from basketry.operators.pick import first_per_key
from basketry.plans.catalog import parse_pages
from basketry.session import cut_lineage
from basketry.sinks.versioned import VersionedTable
from basketry.sources.schemas import PRODUCT_COLUMNS

_PRODUCT = T.StructType([T.StructField(c, T.StringType()) for c in PRODUCT_COLUMNS])
LEDGER = (
    T.StructType().add("product_id", "string").add("pass", "integer").add("attempt", "integer")
    .add("domain", "string").add("status", "string").add("product", _PRODUCT).add("round", "integer")
)
_MADE = ["pass", "attempt", "domain", "status"]


@dataclass(frozen=True)
class Round:
    number: int
    attempts: int
    products: int


def states(rows: DataFrame) -> DataFrame:
    """(product_id, done, pass, tried, last_error) of the products that were tried.

    ``pass`` is the last one of a product and ``tried`` its domains in that pass.  What gathers
    for a product is bounded by its planned domains and passes.
    """
    made = rows.groupBy("product_id").agg(F.sort_array(F.collect_list(F.struct(*_MADE))).alias("made"))
    last = F.element_at("made", -1)
    in_last = F.filter("made", lambda m: m["pass"] == last["pass"])
    return made.select(
        "product_id",
        F.exists("made", lambda m: m["status"] == pages.OK).alias("done"),
        last["pass"].alias("pass"),
        F.transform(in_last, lambda m: m["domain"]).alias("tried"),
        last["status"].alias("last_error"),
    )


def _untried() -> Column:
    return F.array_except("attempts", F.coalesce("tried", F.array().cast("array<string>")))


def with_states(plan: DataFrame, rows: DataFrame) -> DataFrame:
    """The planned products (product_id, attempts) with their states; null states are untouched."""
    wanted = plan.where(F.col("product_id").isNotNull()).select("product_id", "attempts")
    return wanted.join(states(rows), "product_id", "left").withColumn("untried", _untried())


def next_attempts(plan: DataFrame, rows: DataFrame, number: int) -> DataFrame:
    """(product_id, pass, attempt, domain): what pass ``number`` tries next.

    A product that failed in an earlier pass begins with its first domain again; one that was
    left in the middle of an earlier pass goes on there.
    """
    state = with_states(plan, rows).where(~F.coalesce("done", F.lit(False)))
    spent = F.col("tried").isNotNull() & (F.size("untried") == 0)
    again = spent & (F.col("pass") < number)
    domain = F.when(again, F.get("attempts", F.lit(0))).otherwise(F.get("untried", F.lit(0)))
    return state.where(again | ~spent).select(
        "product_id",
        F.when(again | F.col("pass").isNull(), number).otherwise(F.col("pass")).cast("int").alias("pass"),
        F.when(again | F.col("tried").isNull(), 0).otherwise(F.size("tried")).cast("int").alias("attempt"),
        domain.alias("domain"),
    ).where(F.col("domain").isNotNull())


class AttemptLedger:
    """A ledger below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, VersionedTable(spark, root, "round")

    def rows(self) -> DataFrame:
        return self.table.read() if self.table.exists() else self.spark.createDataFrame([], LEDGER)

    def _last(self, column: str) -> int:
        return self.rows().agg(F.max(column)).first()[0] or 0

    def try_next(self, plan: DataFrame, parsed: DataFrame, number: int) -> Round | None:
        """One round: each open task whose page is among the parsed ones; None if there is no such page.

        Of several pages of a product on a domain the first by rank counts; equal ones go by
        their content.
        """
        base = self.table.snapshot()
        rows = self.spark.createDataFrame([], LEDGER) if base is None else self.table.read(base.number)
        this = 1 if base is None else 1 + max(map(int, base.folders))
        tasks = next_attempts(plan, rows, number)
        found = tasks.join(parsed.withColumnRenamed("task_id", "product_id"), ["product_id", "domain"])
        chosen = first_per_key(found, ["product_id"], [F.asc("rank"), F.asc("status"), F.asc("product")])
        product = F.when(F.col("status") == pages.OK, F.col("product")).alias("product")
        made = chosen.select(
            "product_id", "pass", "attempt", "domain", "status", product, F.lit(this).alias("round"))
        version = self.table.append(made, base)
        if version is None:
            return None
        written = self.table.read(version).where(F.col("round") == this)
        attempts, good = written.agg(F.count(F.lit(1)), F.count_if(F.col("status") == pages.OK)).first()
        return Round(this, attempts, good)

    def work(self, plan: DataFrame, stored: DataFrame, *, order: list[str] | None = None,
             rounds: int | None = None, new_pass: bool = False) -> list[Round]:
        """Rounds until no open task has a stored page, or ``rounds`` of them.

        ``stored`` has (product_id, domain, html) and the columns of ``order``; its pages are
        parsed once for all rounds, and only what was parsed is shuffled.  A pass has no more
        rounds that find a page than a product has planned domains.
        """
        order = order or []
        number = max(1, self._last("pass") + int(new_pass))
        plan = cut_lineage(plan.select("product_id", "attempts"), "plan")
        # The order travels as the attempt, which parsing passes on as it is.
        rank = F.struct(F.lit(0).alias("none"), *order).alias("attempt")
        ready = stored.where(F.col("product_id").isNotNull()).select("product_id", "domain", rank, "html")
        tasks = next_attempts(plan, self.rows(), number)
        if tasks.join(ready.select("product_id", "domain"), ["product_id", "domain"], "left_semi").isEmpty():
            return []  # found out without reading a page
        parsed = cut_lineage(parse_pages(ready).select(
            "task_id", F.col("domain_used").alias("domain"), "status", F.struct(*PRODUCT_COLUMNS).alias("product"),
            F.col("attempt").alias("rank")), "parsed")
        made: list[Round] = []
        while rounds is None or len(made) < rounds:
            one = self.try_next(plan, parsed, number)
            if one is None:
                break
            made.append(one)
        return made

    # ---- what the ledger says ----

    def products(self) -> DataFrame:
        """The products found, once each."""
        return self.rows().where(F.col("status") == pages.OK).select("product.*")

    def failures(self, plan: DataFrame) -> DataFrame:
        """(product_id, domains_tried, last_error) of the products whose planned domains all failed."""
        state = with_states(plan, self.rows())
        return state.where(~F.col("done") & (F.size("untried") == 0)).select(
            "product_id", F.array_join("tried", ";").alias("domains_tried"), "last_error")

    def waiting(self, plan: DataFrame) -> DataFrame:
        """(product_id, domain): pages to fetch for the tasks that are open."""
        return next_attempts(plan, self.rows(), max(1, self._last("pass"))).select("product_id", "domain")

"""Filter interaction audit: what every order of a set of filters removes, and who gets the credit.

A row's failing conditions are one number, a bit for each filter, so all a part of the table
has to say about its filters is how many rows have which number.  The states of the audit are
the sets of filters already applied, a lattice with an edge for each filter that comes next;
what an edge removes follows from those counts.  Orders are paths through the lattice: counted
forward they give the orders that reach a state, counted backward the orders that leave it,
and reaching times leaving is the weight of an edge in the Shapley sum.  The steps of a single
order are read from the same edges, so no order is ever run.

Null texts are empty texts, a null part is the empty string, and a failing condition that is
null counts as passed.  A null id is smaller than none and larger than none, so such a row
never fails as a copy; rows that share the smallest id of a text are no copies of each other.
Repeated labels of an id are merged, rows without one are neither good nor toxic.  Every
condition sees the whole text.  An empty table gives no rows.  Columns are picked by name,
others are ignored.
"""

from __future__ import annotations

import itertools
import operator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import WORD, keep, whole

MOST_FILTERS = 6  # 720 orders; a bound on the two broadcast tables, 4,320 and 12,288 rows at most
COPY = "E"


def lattice(names: str) -> list[tuple[int, int, int]]:
    """Edges (state, filter, orders through the edge) of the lattice of applied filters."""
    full = (1 << len(names)) - 1
    reaching, leaving = [0] * (full + 1), [0] * (full + 1)
    reaching[0] = leaving[full] = 1
    for state in range(full + 1):
        for k in range(len(names)):
            if not state >> k & 1:
                reaching[state | 1 << k] += reaching[state]
    for state in range(full - 1, -1, -1):
        leaving[state] = sum(leaving[state | 1 << k] for k in range(len(names)) if not state >> k & 1)
    return [(state, k, reaching[state] * leaving[state | 1 << k])
            for state in range(full) for k in range(len(names)) if not state >> k & 1]


def paths(names: str) -> list[tuple[str, int, int, int]]:
    """(order, step, state before the step, filter of the step) of every order."""
    made = []
    for order in itertools.permutations(range(len(names))):
        state = 0
        for step, k in enumerate(order, 1):
            made.append(("".join(names[i] for i in order), step, state, k))
            state |= 1 << k
    return made


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions on a text alone, by letter."""
    text = whole(text)
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(found) < 50,
        "B": 100 * F.size(F.array_distinct(found)) < 65 * F.size(found),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failing_bits(failures: dict[str, Column]) -> Column:
    """One number with a bit for each failing condition, the first in the lowest place."""
    return reduce(operator.add, (F.when(failed, F.lit(1 << k)).otherwise(F.lit(0))
                                 for k, failed in enumerate(failures.values())))


def copy_marked(rows: DataFrame, digest: str, doc_id: str, result: str) -> DataFrame:
    """rows with whether an equal digest occurs with a smaller id.

    The smallest id of a digest is one aggregate.  It is joined by id and digest, of which no
    pair is hot unless an id is, so a text that makes up a third of the table stays spread.
    """
    first = rows.where(F.col(doc_id).isNotNull()).groupBy(digest).agg(F.min(doc_id).alias(doc_id))
    marked = rows.join(first.withColumn("__first", F.lit(True)), [doc_id, digest], "left")
    return marked.withColumn(result, F.col(doc_id).isNotNull() & F.col("__first").isNull()).drop("__first")


def bits_counted(rows: DataFrame, part: str, flags: list[str]) -> DataFrame:
    """(part, bits, n, rows with each flag): the only pass over the rows, combined map-side."""
    return rows.groupBy(part, "bits").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col(f), 1)).alias(f) for f in flags])


def effects(spark: SparkSession, names: str) -> DataFrame:
    """What every edge does to rows with given bits, a flag for each outcome; 2,560 rows for five filters."""
    made = []
    for state, k, orders in lattice(names):
        for bits in range(1 << len(names)):
            fails, gone = bits >> k & 1, bits & state != 0
            made.append({"bits": bits, "state": state, "filter": k, "orders": orders, "kept": int(not fails and not gone),
                         "removed": int(fails and not gone), "redundant": int(fails and gone), "alone": int(bits == 1 << k)})
    return spark.createDataFrame(pa.Table.from_pylist(made))


def orders_table(spark: SparkSession, names: str) -> DataFrame:
    """The steps of all orders; as many rows as `paths` has, whatever the size of the data."""
    columns = zip(*paths(names), strict=True)
    return spark.createDataFrame(pa.table(dict(zip(("filter_order", "step", "state", "filter"), columns, strict=True))))


def edges(counts: DataFrame, part: str, flags: list[str], names: str) -> DataFrame:
    """What every edge of the lattice removes in a part, and the Shapley sum of its filter.

    A part has at most one count for each number, so an edge adds up 32 rows for five filters.
    """
    total = lambda value, flag: F.sum(F.col(value) * F.col(flag))
    summed = counts.join(F.broadcast(effects(counts.sparkSession, names)), "bits").groupBy(part, "state", "filter").agg(
        F.max("orders").alias("orders"), total("n", "kept").alias("kept"), total("n", "removed").alias("removed"),
        total("n", "redundant").alias("redundant"), total("n", "alone").alias("unique_fails"),
        *[total(f, "removed").alias(f"{f}_lost") for f in flags])
    credit = F.sum(F.col("orders") * F.col("removed")).over(Window.partitionBy(part, "filter"))
    return summed.withColumn("shapley", credit)


def audit(counts: DataFrame, part: str, flags: list[str], names: str) -> DataFrame:
    """A row per part, order and step from the counts of `bits_counted`."""
    if len(names) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters: the orders of more are too many to list")
    steps = F.broadcast(orders_table(counts.sparkSession, names))
    return edges(counts, part, flags, names).join(steps, ["state", "filter"]).select(
        part, "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails",
        *[f"{f}_lost" for f in flags], "shapley")


def audit_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source") -> DataFrame:
    """The five filters of a text corpus, audited for every source, with the good and toxic rows lost."""
    failures = text_failures(F.col("text"))
    thin = keep(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")).select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), failing_bits(failures).alias("bits"),
        F.unhex(F.sha2(whole(F.col("text")).cast("binary"), 256)).alias("digest")), "audited")
    names = "".join(failures) + COPY
    marked = copy_marked(thin, "digest", "doc_id", "is_copy").withColumn(
        "bits", F.col("bits") + F.when(F.col("is_copy"), 1 << len(failures)).otherwise(0))
    known = labels.where(f"{doc_id} is not null").groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    counts = bits_counted(marked.join(known, "doc_id", "left"), "part", ["good", "toxic"])
    return audit(counts, "part", ["good", "toxic"], names)

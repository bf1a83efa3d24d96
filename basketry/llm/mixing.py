"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the running total of its source's words in
shuffled order, divided by the source's target.  All documents are range-sorted by that time
and taken until the budget is used up.  A source whose target exceeds its size is queued
again, up to `REPEATS` times.

Null texts have no words; null sources form one source, the last; null ids, repeated rows and
ties are ordered by shuffle key, id, size and row.  A source without words has target 0 and
gives nothing.  Only the named columns are read, the others are carried by `mix_rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import WORD, keep, whole

WEIGHTS = (3, 1, 2)  # by source in order of code points, repeating
SHARE = 1.5  # words of the mix, in words of all documents
REPEATS = 2  # times a document may be taken
BUCKETS = 4096  # pieces of a source's queue that are added up on their own


def shuffle_key(doc_id: Column, epoch: Column) -> Column:
    """60 bits that put a source's documents in a random but repeatable order."""
    digest = F.md5(F.concat_ws(":", epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Target of each source from (source, source_size): shares by weight, none above its bound.

    Water filling: sources in the order in which they reach their bound; `level` is what a
    unit of weight gets once the earlier ones are full.  One row per source, so one small task.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = ranked.select("source", "source_size", "rank",
                            F.get(weights, F.col("rank") % len(WEIGHTS)).alias("weight"),
                            (REPEATS * F.col("source_size")).alias("bound"))
    order = Window.orderBy(F.col("bound") / F.col("weight"), "rank")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * SHARE
    filled = weighed.withColumn(
        "level", (budget - F.coalesce(F.sum("bound").over(earlier), F.lit(0))) / F.sum("weight").over(later))
    open_ones = F.when(F.col("level") <= F.col("bound") / F.col("weight"), F.col("level"))
    levelled = filled.withColumn("common", F.coalesce(F.max(open_ones).over(everything), F.lit(float("inf"))))
    return levelled.select("source", "source_size", "rank",
                           F.least(F.col("common") * F.col("weight"), F.col("bound").cast("double")).alias("target"))


def queue(rows: DataFrame) -> DataFrame:
    """Virtual finish time of every row and repeat; rows has row, doc_id, source, size and the source's target.

    The running total of a source is added up in pieces: first inside each of `BUCKETS`
    ranges of the shuffle key, then over the ranges, so no source is sorted in one task.
    """
    queued = rows.where("target > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("target") / F.col("source_size")).cast("int"))))
    queued = queued.withColumn("key", shuffle_key(F.col("doc_id"), F.col("epoch")))
    queued = queued.withColumn("bucket", F.shiftright("key", 60 - (BUCKETS - 1).bit_length()))
    inside = ["rank", "epoch", "bucket"]
    heads = queued.groupBy(*inside).agg(F.sum("size").alias("words")).withColumn(
        "before", F.sum("words").over(Window.partitionBy("rank").orderBy("epoch", "bucket")) - F.col("words"))
    running = F.sum("size").over(Window.partitionBy(*inside).orderBy("key", "doc_id", "size", "row")
                                 .rowsBetween(Window.unboundedPreceding, 0))
    timed = queued.join(heads.drop("words"), inside).withColumn("time", (F.col("before") + running) / F.col("target"))
    return timed.select("row", "rank", "epoch", "key", "doc_id", "size", "time")


def take(queued: DataFrame, budget: float) -> DataFrame:
    """Words taken from each row: the queue in global order, up to the budget."""
    order = ["time", "rank", "epoch", "key", "doc_id", "size", "row"]
    parts = int(queued.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keep(queued.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "queue")
    rest, last = budget, -1
    for part in ranged.groupBy("part").agg(F.sum("size").alias("words")).orderBy("part").collect():
        last = part["part"]
        if part["words"] > rest:
            break
        rest -= part["words"]
    else:
        last += 1  # the budget covers the whole queue
    split = ranged.where(F.col("part") == last).withColumn("so_far", F.sum("size").over(
        Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    taken = ranged.where(F.col("part") < last).select("row", "size").union(
        split.where(F.col("so_far") <= rest).select("row", "size"))
    return taken.groupBy("row").agg(F.sum("size").alias("taken"), F.count("*").alias("copies"))


def mix_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             prefix: str = "") -> DataFrame:
    """All rows with size, source_size, target, taken and copies, named with the prefix."""
    inner = "__mix_row"
    numbered = keep(docs.withColumn(inner, F.monotonically_increasing_id()).withColumn(
        "__mix_size", F.regexp_count(whole(F.col(text)), F.lit(WORD)).cast("long")), "numbered")
    thin = numbered.select(F.col(inner).alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                           F.col("__mix_size").alias("size"))
    goals = keep(targets(thin.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    goal = goals.withColumnRenamed("source", "goal_source")
    rows = thin.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    budget = goals.agg(F.sum("target")).first()[0] or 0.0
    taken = take(queue(rows), budget)
    decided = rows.join(taken, "row", "left").select(
        F.col("row").alias(inner), F.col("source_size").alias(f"{prefix}source_size"),
        F.col("target").alias(f"{prefix}target"), F.coalesce("taken", F.lit(0)).alias(f"{prefix}taken"),
        F.coalesce("copies", F.lit(0)).alias(f"{prefix}copies"))
    return numbered.withColumnRenamed("__mix_size", f"{prefix}size").join(decided, inner).drop(inner)

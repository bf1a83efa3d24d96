"""From raw documents to a training mix: toxicity, language, near-duplicates, benchmark leaks, mixing.

A stage takes all rows its predecessor kept and returns the rows it keeps, with all their
columns; the last adds how often and with how many words a document is taken.  Rows with
null or empty texts pass the toxicity test, but no language can be told for them.  Of repeated
rows, and of ties between copies, the row stored first stays; rows that share an id, or have a
null one, are told apart by their texts.  The stages work on columns of their own, so extra
columns of the documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontam, langid, mixing, neardup, toxicity
from basketry.llm.common import keep, prepare, table

ROW = "__pipeline_row"


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the level."""
    prepare(spark)
    weights = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(weights, docs, F.col("text")) < toxicity.LEVEL)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known well enough."""
    prepare(spark)
    found = langid.identify(docs, langid.learn(docs), F.col("text"), declared=F.col("lang"), host=F.col("source"),
                            suffix=F.lit(""), result="__language")
    return found.where(F.col("__language.posterior") >= langid.LEAST).drop("__language")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each near-duplicate group.

    Rows are grouped by a number of their own, so documents that share an id, or have none, are
    told apart by their texts alone.  Texts stay where they are unless their row may be one of
    those that go.
    """
    prepare(spark)
    numbered = keep(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    judged = neardup.components(numbered, doc_id=ROW)
    gone = keep(judged.where("not kept").select(F.col("doc_id").alias(ROW)), "copies")
    split = numbered.withColumn("__open", neardup.sieve(gone.select(F.col(ROW).alias("id")), numbered, ROW))
    sure, open_ones = split.where("not __open"), split.where("__open")
    return sure.unionByName(open_ones.join(gone, ROW, "left_anti")).select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    prepare(spark)
    return docs.where(F.size(decontam.matches(F.col("text"), table(spark, sf_dir, "benchmark"))) == 0)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with mix_copies (times taken) and mix_taken (words taken)."""
    prepare(spark)
    return mixing.mix_rows(docs, prefix="mix_").where("mix_copies > 0").drop("mix_size", "mix_source_size", "mix_target")


STAGES = [
    ("toxicity", not_toxic),
    ("language_id", known_language),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_leaks),
    ("mixing", mixed),
]

# The learned stages cannot be said in SQL; tests compare the others with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

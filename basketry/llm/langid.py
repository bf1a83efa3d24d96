"""Language identification by Bayesian evidence fusion.

The text gives a likelihood per language (letter trigrams, learned from a bounded sample of
labelled rows, `SAMPLE` per language).  The declared language (markup or a column) and the
address suffix each multiply in how often they go with a language, and the prior comes from
the host, smoothed towards its domain and then towards the whole corpus.  All of these are
grouped aggregates over every row; the languages themselves number `MOST_LANGUAGES` at most.

Null or empty texts, and texts without letters, have no likelihood: they get language null
and posterior 0.  Null declarations, suffixes and hosts are values of their own.  Repeated
rows count as often as they occur; ties go to the first language in order.  Other columns
are carried; the result is one struct column under the caller's name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import keep, whole

BITS = 16  # of a trigram's number
SAMPLE = 1000  # labelled texts per language
MOST_LANGUAGES = 64
EVIDENCE = 60.0  # trigrams a text counts for at most, so that other evidence is heard
SMOOTH = 20.0  # rows that a prior from the level above is worth
LEAST = 0.6  # posterior from which on a language is taken as known
NOT_LETTERS = re.compile(r"[\W\d_]+")


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and trigram number of every three letters in a row, words framed by blanks."""
    cleaned = [NOT_LETTERS.sub(" ", text.lower()).strip() if text else "" for text in texts]
    framed = [f" {text} " if text else "" for text in cleaned]
    codes = np.frombuffer("".join(framed).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(text) for text in framed])
    if len(codes) < 3:
        return owner[:0], np.zeros(0, np.int64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
             + codes[2:] * np.uint64(0x165667B19E3779F9))
    numbers = ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)
    same = owner[:-2] == owner[2:]
    return owner[:-2][same], numbers[same].astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # (trigram, language) log-probabilities

    def likelihoods(self, texts: list[str | None]) -> list[list[float] | None]:
        """Log-likelihood per language, of as many trigrams as count; null without letters."""
        owner, numbers = trigrams(texts)
        count = np.bincount(owner, minlength=len(texts))
        sums = np.stack([np.bincount(owner, self.logs[:, k][numbers], len(texts)) for k in range(len(self.languages))], 1)
        mean = sums / np.maximum(count, 1)[:, None] * np.minimum(count, EVIDENCE)[:, None]
        return [row.tolist() if n else None for row, n in zip(mean, count)]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Trigram frequencies of a sample of the labelled rows of each language."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang).alias("lang"))
    frequent = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    chosen = labelled.join(frequent.select("lang"), "lang").withColumn("nth", F.row_number().over(order)).where(
        F.col("nth") <= sample).select("key", F.col("lang").alias("known")).distinct()
    chosen = keep(chosen, "language-sample")
    rows = docs.select(F.col(key).alias("key"), F.col(lang).alias("known"), F.col(text).alias("text")).join(chosen, ["key", "known"])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, inverse = np.unique(batch["known"].to_numpy(str), return_inverse=True)
            owner, numbers = trigrams(batch["text"].tolist())
            codes, n = np.unique(inverse[owner] << BITS | numbers, return_counts=True)
            yield pd.DataFrame({"lang": langs[codes >> BITS], "gram": codes & ((1 << BITS) - 1), "n": n})

    counts = (rows.mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram")
              .agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counts["lang"].unique())
    table = np.full((1 << BITS, max(1, len(languages))), 0.5)
    for k, language in enumerate(languages):
        part = counts[counts["lang"] == language]
        table[part["gram"], k] += part["n"]
    return Model(languages or ["und"], np.log(table / table.sum(0)))


def likelihoods(model: Model, docs: DataFrame, text: Column) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def logs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.likelihoods(batch.tolist()), dtype=object)

    return logs(text)


def _smoothed(counts: Column, parent: Column) -> Column:
    """Shares per language, with the parent's shares as `SMOOTH` more rows."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, parent, lambda n, p: (n + SMOOTH * p) / (total + SMOOTH))


def evidence(votes: DataFrame, languages: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Log-priors per host, and log-weights per declared language and per suffix.

    Votes has domain, host, suffix, declared, vote (the language of the text's likelihood
    alone) and the number of such rows.
    """
    counts = F.array(*[F.sum(F.when(F.col("vote") == k, F.col("count")).otherwise(0)).cast("double") for k in range(languages)])
    total = votes.agg(counts.alias("n")).first()["n"]  # one number per language
    rows = sum(n or 0.0 for n in total) + languages
    corpus = F.array(*[F.lit(((n or 0.0) + 1.0) / rows) for n in total])
    domains = votes.groupBy("domain").agg(counts.alias("n")).select("domain", _smoothed(F.col("n"), corpus).alias("share"))
    hosts = votes.groupBy("host", "domain").agg(counts.alias("n")).join(domains, "domain").select(
        "host", F.transform(_smoothed(F.col("n"), F.col("share")), lambda x: F.ln(x)).alias("prior"))

    def weights(clue: str) -> DataFrame:
        shares = votes.groupBy(clue).agg(counts.alias("n")).select(clue, _smoothed(F.col("n"), corpus).alias("share"))
        return shares.select(clue, F.zip_with("share", corpus, lambda a, b: F.ln(a / b)).alias(f"{clue}_log"))

    return hosts, weights("declared"), weights("suffix")


def _best(values: Column) -> Column:
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def identify(docs: DataFrame, model: Model, text: Column, declared: Column, host: Column, suffix: Column,
             result: str = "language") -> DataFrame:
    """Add a struct of lang, posterior and text_lang."""
    languages = len(model.languages)
    logs = likelihoods(model, docs, text)
    clues = {"host": whole(host), "suffix": whole(suffix), "declared": whole(F.lower(declared))}
    domain = F.regexp_extract("host", r"([^.]*\.[^.]*)$", 1)  # the last two labels; none without a dot
    votes = docs.select(*[clue.alias(name) for name, clue in clues.items()], logs.alias("logs")).where("logs is not null")
    counted = keep(votes.withColumn("domain", domain).withColumn("vote", _best(F.col("logs")))
                   .groupBy("domain", "host", "suffix", "declared", "vote").count(), "language-votes")
    hosts, by_declared, by_suffix = (keep(t, "language-evidence") for t in evidence(counted, languages))
    rows = docs.withColumns({f"__{name}": clue for name, clue in clues.items()} | {"__logs": logs})
    for table in (hosts, by_declared, by_suffix):
        clue, log = table.columns
        rows = rows.join(table.withColumnsRenamed({clue: f"__{clue}", log: f"__{log}"}), f"__{clue}", "left")
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    rows = rows.withColumn("__total", add(add(add(F.col("__logs"), F.col("__prior")), F.col("__declared_log")), F.col("__suffix_log")))
    top = F.array_max("__total")
    mass = F.aggregate(F.transform("__total", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, b: a + b)
    names = F.array(*[F.lit(language) for language in model.languages])
    name = lambda values: F.when(values.isNotNull(), F.get(names, _best(values)))
    fused = F.struct(name(F.col("__total")).alias("lang"), F.coalesce(1.0 / mass, F.lit(0.0)).alias("posterior"),
                     name(F.col("__logs")).alias("text_lang"))
    inner = [c for c in rows.columns if c.startswith("__") and c not in docs.columns]
    return rows.withColumn(result, fused).drop(*inner)


def identify_pages(pages: DataFrame, model: Model, url: str = "url", html: str = "html", result: str = "language") -> DataFrame:
    """Languages of web pages: text between tags, `lang` of the markup, and the end of the host's name."""
    page = whole(F.col(html))
    text = F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract(page, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1)
    host = F.lower(F.regexp_extract(whole(F.col(url)), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    suffix = F.regexp_extract(host, r"\.([^.]+)$", 1)
    return identify(pages, model, text, declared, host, suffix, result)

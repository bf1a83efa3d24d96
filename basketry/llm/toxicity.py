"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The model is fitted on a bounded sample of labelled rows (`SAMPLE` documents, those with the
lowest hash of their id); its features are counted in Spark, its weights are learned in numpy
with a learning rate per coordinate, and L1 leaves so few of them that they are broadcast.

Null and empty texts have no features and get the score of the bias alone.  Rows whose label
or id is null are not learned from; ids and texts labelled twice count as toxic if one label
says so.
Without any labelled row every score is `PRIOR`.  Long texts are read whole.  `score` is a
column function, so other columns, repeated rows and ties are left as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import remainder

BITS = 20  # of a feature's number
SAMPLE = 8000  # labelled documents learned from, at most
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 1.0
PRIOR = 0.01
LEVEL = 0.3  # scores from here on are toxic
MEMO = 500_000  # words a task remembers the hash of
TOKEN = re.compile(r"[^\W_]+")


class WordHashes(dict):
    """Hash of each word seen; forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "replace")) + 1
        return value


def _spread(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((values ^ (values >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)


def grams(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature number of every word, word pair and pair with one word between."""
    tokens = [TOKEN.findall(text.lower()) if text else [] for text in texts]
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    owner = np.repeat(np.arange(len(tokens)), lengths)
    word = np.fromiter((hashes[w] for doc in tokens for w in doc), np.uint64, int(lengths.sum()))
    owners, features = [owner], [_spread(word)]
    for step, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        same = owner[:-step] == owner[step:]
        pair = word[:-step] * np.uint64(factor) + word[step:] * np.uint64(0x165667B19E3779F9)
        owners.append(owner[:-step][same])
        features.append(_spread(pair)[same])
    return np.concatenate(owners), np.concatenate(features).astype(np.int64)


@dataclass(frozen=True)
class Weights:
    """The weights that are not zero."""

    features: np.ndarray
    values: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << BITS, np.float32)
        dense[self.features] = self.values
        return dense

    def scores(self, texts: list[str | None], dense: np.ndarray, hashes: WordHashes) -> np.ndarray:
        """Probability of each text; a feature counts once however often it occurs."""
        owner, feature = grams(texts, hashes)
        weighty = np.flatnonzero(dense[feature])
        once = np.unique(owner[weighty] << BITS | feature[weighty])
        total = np.bincount(once >> BITS, dense[once & ((1 << BITS) - 1)], len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total + self.bias, -30, 30)))


def fit(examples: list[tuple[np.ndarray, int]]) -> Weights:
    """FTRL-proximal over examples of (distinct features, 0 or 1), in the given order."""
    if not examples:
        return Weights(np.zeros(0, np.int64), np.zeros(0, np.float32), float(np.log(PRIOR / (1 - PRIOR))))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0
    free = lambda z, n: -z / ((BETA + np.sqrt(n)) / ALPHA + L2)
    shrunk = lambda z, n: np.where(np.abs(z) > L1, free(z - np.sign(z) * L1, n), 0.0)
    for _ in range(EPOCHS):
        for features, label in examples:
            w, bias = shrunk(z[features], n[features]), free(bias_z, bias_n)
            slope = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -30, 30))) - label
            grown = n[features] + slope * slope
            z[features] += slope - (np.sqrt(grown) - np.sqrt(n[features])) / ALPHA * w
            n[features] = grown
            bias_z += slope - (np.sqrt(bias_n + slope * slope) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += slope * slope
    weights = shrunk(z, n)
    used = np.flatnonzero(weights)
    return Weights(used, weights[used].astype(np.float32), float(free(bias_z, bias_n)))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE) -> Weights:
    """Fit on the labelled rows outside the held-out fold (crc32 of the id modulo 4 is 2)."""
    chosen = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isNotNull() & (remainder(F.col("id"), 4) != 2))
              .groupBy("id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(chosen, "id")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            owner, feature = grams(batch["text"].tolist(), hashes)
            once = np.unique(owner << BITS | feature)
            ends = np.searchsorted(once >> BITS, np.arange(1, len(batch)))
            batch["features"] = [part.astype(np.int32) for part in np.split(once & ((1 << BITS) - 1), ends)]
            yield batch[["id", "label", "features"]]

    # A copied text is one example, toxic if one copy is; so rows that share an id add no more
    # than their distinct texts, and what comes to the driver is bounded by rows too.
    place = F.struct(F.crc32(F.col("id").cast("string").cast("binary")).alias("mixed"), "id")
    counts = rows.mapInPandas(counted, "id long, label int, features array<int>")
    once = counts.groupBy("features").agg(F.min(place).alias("place"), F.max("label").alias("label"))
    gathered = once.orderBy("place", "features").limit(sample).select("features", "label").toArrow()
    examples: list[tuple[np.ndarray, int]] = []
    for batch in gathered.to_batches():
        features = batch.column("features")
        values, ends, labels_of = features.values.to_numpy(), features.offsets.to_numpy(), batch.column("label").to_numpy()
        examples.extend((values[ends[k]:ends[k + 1]], int(labels_of[k])) for k in range(len(batch)))
    return fit(examples)


def score(weights: Weights, docs: DataFrame, text: Column) -> Column:
    """Probability that a text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense, hashes = shared.value.table(), WordHashes()
        for batch in batches:
            yield pd.Series(shared.value.scores(batch.tolist(), dense, hashes))

    return scored(text)

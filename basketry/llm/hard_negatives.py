"""Hard negatives: for each anchor and near row of its label, the nearest rows of other labels that score no higher.

Vectors are turned into integers, so scores are exact.  Every row stores its angles to a few
reference directions; rows are sorted by nearest reference and angle and cut into windows that
know their range of angles and norms.  On the sphere an angle cannot be less than the
difference of two angles to a common reference, nor more than their sum, so the ranges bound
the cosine between an anchor and all rows of a window; times the norms, and widened by more
than rounding can move them, they bound the score.  Only windows whose bounds overlap the
scores that can still matter are scored, in integers.

A row with a null id, label or vector, a component that is null or not finite, or a vector of another
length than most rows have takes no part.  Ties go to the smaller id.  Rows that repeat an id
are candidates each on its own, but never for an anchor of that id; of anchors with one id the
first by label and vector counts.  Scores beyond a long are cut to its range and tie there.
Without anchors or rows the result is empty.  Columns are picked by name, others are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import keep

SCALE = 256
REFERENCES = 24  # directions that angles are stored for
SAMPLE = 4096  # rows the references are picked from; they change the speed, not the result
WINDOW = 400  # rows that are bounded together
SLICE = 2048  # searches scored together with a window
PROBE = 64  # one row in so many is looked at first, for scores to start from
BLOCK_BYTES = 16 << 20  # of anchors searched for at once: what is broadcast
NEAREST = 5
LEAST_SHARE = 80  # per cent of the positive's score that a negative reaches
SAFE = 1e-6  # relative and absolute slack of angles and bounds, far above the rounding of doubles
EXACT = 2.0**52  # doubles add up integers below this without error
LONG = np.iinfo(np.int64)


def usable(rows: DataFrame, anchor: Column, vec_id: str, label: str, vector: str) -> DataFrame:
    """(vec_id, label, v) of rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x * SCALE) < float("inf")), F.lit(False)))
    known = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    return rows.where(known & fine & (F.size(vector) > 0)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), v.alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"))


def whole_numbers(v: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * v)


def matrix(column: pd.Series | list) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms, without overflow; a zero vector keeps direction zero."""
    top = np.abs(v).max(axis=1, initial=0.0)[:, None]
    scaled = v / np.where(top > 0, top, 1.0)
    length = np.sqrt((scaled * scaled).sum(axis=1))[:, None]
    return scaled / np.where(length > 0, length, 1.0), (top * length)[:, 0]


def angles(directions: np.ndarray, references: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions @ references.T, -1.0, 1.0))


def pick_references(sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Rows far from each other: each next one is the row farthest from those picked so far."""
    directions = unit(sample)[0]
    picked, nearest = [0], directions @ directions[0]
    while len(picked) < min(count, len(directions)):
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, directions @ directions[picked[-1]])
    return directions[picked]


def index(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """rows with norm, angles and place, sorted by nearest reference, angle and id.

    The global range sort ends with the id, so even a large group of equal vectors is spread.
    """

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                v = whole_numbers(matrix(batch["v"]))
                directions, norms = unit(v)
                found = angles(directions, references)
                nearest = found.argmin(axis=1)
                yield batch.assign(v=list(v), norm=norms, angles=list(found), place=nearest,
                                   angle=found[np.arange(len(found)), nearest])

    schema = T.StructType([*rows.schema, *(T.StructField(name, kind) for name, kind in (
        ("norm", T.DoubleType()), ("angles", T.ArrayType(T.DoubleType())), ("place", T.IntegerType()), ("angle", T.DoubleType())))])
    made = rows.mapInPandas(measured, schema)
    order = ["place", "angle", "vec_id"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keep(made.repartitionByRange(parts, *order).sortWithinPartitions(*order), "angles")


@dataclass(frozen=True)
class Anchors:
    """A block of anchors: what is broadcast to the tasks."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    norms: np.ndarray
    angles: np.ndarray


def bounds(anchors: Anchors, window_angles: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score each anchor can have with a row of the window."""
    low, high = window_angles.min(axis=0) - SAFE, window_angles.max(axis=0) + SAFE
    gap = np.maximum(low - anchors.angles, anchors.angles - high).max(axis=1, initial=0.0)
    around = np.minimum(anchors.angles + high, 2 * np.pi - anchors.angles - low).min(axis=1, initial=np.pi)
    top, bottom = np.cos(np.clip(gap, 0, np.pi)), np.cos(np.clip(around, 0, np.pi))
    most = np.where(top > 0, top * norms.max(), top * norms.min()) * anchors.norms
    least = np.where(bottom > 0, bottom * norms.min(), bottom * norms.max()) * anchors.norms
    slack = SAFE * (1.0 + norms.max() * anchors.norms)
    least, most = least - slack, most + slack  # products beyond the largest double bound nothing
    return np.where(np.isfinite(least), least, -np.inf), np.where(np.isfinite(most), most, np.inf)


def scores(a: np.ndarray, b: np.ndarray, norms: float) -> np.ndarray:
    """Exact integer inner products; `norms` is a bound on the product of two norms."""
    if norms < EXACT:
        return (a @ b.T).astype(np.int64)
    exact = a.astype(object), b.astype(object)
    whole = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in exact[1]] for p in exact[0]]
    return np.array([[min(max(s, LONG.min), LONG.max) for s in row] for row in whole], np.int64).reshape(len(a), len(b))


class Best:
    """The first rows of each search by score and id, as they come in.

    A search is an anchor with a range of scores; `least` rises with the NEAREST-th best score
    found so far and never passes a row that belongs to the result.
    """

    def __init__(self, anchor: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.anchor, self.least, self.most = anchor, least.copy(), most
        self.found = [np.zeros((0, 3), np.int64)]  # search, score, id
        self.waiting = 0

    def offer(self, searches: np.ndarray, scored: np.ndarray, eligible: np.ndarray, ids: np.ndarray) -> None:
        fits = eligible & (scored >= self.least[searches, None]) & (scored <= self.most[searches, None])
        row, column = np.nonzero(fits)
        if len(row):
            self.found.append(np.stack([searches[row], scored[row, column], ids[column]], axis=1))
            self.waiting += len(row)
        if self.waiting > 200_000:
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate(self.found)
        order = np.lexsort((rows[:, 2], -rows[:, 1].astype(np.float64), rows[:, 0]))
        # Doubles can merge neighbouring scores of more than 53 bits; sort those exactly.
        if len(rows) and np.abs(rows[:, 1]).max(initial=0) >= EXACT:
            order = np.array(sorted(range(len(rows)), key=lambda i: (rows[i, 0], -int(rows[i, 1]), rows[i, 2])))
        rows = rows[order]
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]]) if len(rows) else np.zeros(0, np.int64)
        rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
        rows = rows[rank < NEAREST]
        last = rows[np.flatnonzero(rank[rank < NEAREST] == NEAREST - 1)]
        self.least[last[:, 0]] = np.maximum(self.least[last[:, 0]], last[:, 1])
        self.found, self.waiting = [rows], 0
        return rows


def searched(rows: DataFrame, shared: Broadcast, same_label: bool) -> DataFrame:
    """(search, score, id): the best rows of each search in each task, of the anchor's label or of others.

    `shared` has the anchors and, for each search, its anchor and least and largest score.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, *searches = shared.value
        best = Best(*searches)
        for batch in batches:
            for start in range(0, len(batch), WINDOW):
                window = batch.iloc[start:start + WINDOW]
                norms, v = window["norm"].to_numpy(), matrix(window["v"])
                ids, labels = window["vec_id"].to_numpy(), window["label"].to_numpy()
                low, high = bounds(a, matrix(window["angles"]), norms)
                overlap = np.flatnonzero((high[best.anchor] >= best.least) & (low[best.anchor] <= best.most))
                for first in range(0, len(overlap), SLICE):
                    part = overlap[first:first + SLICE]
                    used, place = np.unique(best.anchor[part], return_inverse=True)
                    scored = scores(a.v[used], v, float(a.norms[used].max() * norms.max()))
                    fits = ((a.labels[used, None] == labels) == same_label) & (a.ids[used, None] != ids)
                    best.offer(part, scored[place], fits[place], ids)
            best.settle()
        yield pd.DataFrame(best.settle(), columns=["search", "score", "id"])

    return rows.select("vec_id", "label", "v", "norm", "angles").mapInPandas(look, "search long, score long, id long")


def first_of_each(found: DataFrame) -> DataFrame:
    """The best over all tasks, each of which sends NEAREST rows of a search at most."""
    order = Window.partitionBy("search").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEAREST)


def mine_block(indexed: DataFrame, anchors: Anchors) -> DataFrame:
    """Hard negatives of a block of anchors, small enough to be broadcast, as a written table.

    One row in PROBE is searched first: its NEAREST-th best positive is a score that the whole
    table reaches too, so most windows need no look afterwards.
    """
    spark, every = indexed.sparkSession, np.arange(len(anchors.ids))
    least, most = np.full(len(every), LONG.min), np.full(len(every), LONG.max)
    shares = [spark.sparkContext.broadcast((anchors, every, least, most))]
    probe = indexed.where(F.pmod(F.xxhash64("vec_id"), F.lit(PROBE)) == 0)
    begun = first_of_each(searched(probe, shares[0], True)).where(F.col("rank") == NEAREST).toPandas()
    least = least.copy()
    least[begun["search"].to_numpy(np.int64)] = begun["score"].to_numpy(np.int64)
    shares.append(spark.sparkContext.broadcast((anchors, every, least, most)))
    positives = keep(first_of_each(searched(indexed, shares[1], True)), "positives")

    wanted = positives.select("search", "score").distinct().orderBy("search", "score").toPandas()
    wanted["least"] = [-(-LEAST_SHARE * int(p) // 100) for p in wanted["score"]]
    wanted = wanted[wanted["least"] <= wanted["score"]]  # no score lies between for a negative one
    ranges = [wanted[c].to_numpy(np.int64) for c in ("search", "least", "score")]
    shares.append(spark.sparkContext.broadcast((anchors, *ranges)))
    negatives = first_of_each(searched(indexed, shares[2], False))
    searches = spark.createDataFrame(pa.table({
        "search": np.arange(len(wanted)), "anchor": ranges[0], "positive_score": ranges[2], "anchor_id": anchors.ids[ranges[0]]}))
    of_positive = positives.select(F.col("search").alias("anchor"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    made = keep(negatives.join(searches, "search").join(of_positive, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")), "negatives")
    for share in shares:
        share.destroy()
    return made


def mine(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label",
         vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    Anchors are taken in blocks of bounded size, each with its passes over the stored angles;
    a block's result is written before the next block starts.
    """
    own = usable(rows, is_anchor, vec_id, label, vector)
    lengths = own.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    length = lengths[0]["n"] if lengths else 1
    own = own.where(F.size("v") == length)
    sample = matrix(own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"])
    references = pick_references(whole_numbers(sample)) if len(sample) else np.ones((1, length))
    indexed = index(own, references)
    anchors = keep(indexed.where("anchor").groupBy("vec_id").agg(
        F.min(F.struct("label", "v", "norm", "angles")).alias("a")).select("vec_id", "a.*"), "anchors")
    blocks = max(1, -(-anchors.count() * 8 * (length + REFERENCES + 3) // BLOCK_BYTES))
    made = []
    for block in range(blocks):
        chosen = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).orderBy("vec_id").toPandas()
        if len(chosen) or not made:
            made.append(mine_block(indexed, Anchors(
                chosen["vec_id"].to_numpy(np.int64), chosen["label"].to_numpy(), matrix(chosen["v"]).reshape(len(chosen), length),
                chosen["norm"].to_numpy(np.float64), matrix(chosen["angles"]).reshape(len(chosen), len(references)))))
    return reduce(DataFrame.unionByName, made)

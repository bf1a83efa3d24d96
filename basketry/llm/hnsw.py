"""Approximate nearest neighbours: a navigable small-world graph per shard, shard results merged.

Rows are dealt to shards of bounded size.  Each shard is one task's graph: nodes are numbered
by falling level, so layer L is the first nodes, and its arcs are one flat array with a fixed
number of places per node.  Nodes are inserted in small batches, each found by a search of the
graph so far and linked to diverse neighbours.  The graphs are a table, one row per shard;
queries are broadcast in blocks of bounded size, walk every shard's graph, and the best of
all shards are merged.

Equal vectors of a shard are one node with a list of ids, so copies cannot cut a graph apart,
and nodes no walk from the top reaches get an arc from a neighbour that one does.  Walks use
single precision; what they find is scored again on the original vectors in double precision.

A row with a null id or vector, a zero vector, a component that is null or not finite, or a
vector of another length than most rows have takes no part.  Ties go to the smaller id.  A
repeated row is found as often as it occurs, but never for a query of its id; of queries with
one id the first by vector counts.  Without queries or rows the result is empty.  Columns are
picked by name, others are ignored.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import keep

NEAREST = 5
SHARD_ROWS, SHARD_BYTES = 8192, 64 << 20  # of a shard, on average
BLOCK_BYTES = 16 << 20  # of queries walked at once: what is broadcast
ARCS = 16  # kept per node in the upper layers, twice as many in the lowest
SPARE = 16  # places for arcs from later nodes before a list is thinned out
BREADTH = 64  # nodes a walk keeps in view, in building
VIEW = 96  # the same, in searching
BATCH = 256  # nodes inserted, or queries walked, together
STEP = 4  # nodes a walk opens at a time


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & fine & F.exists(v, lambda x: x != 0)).select(
        F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def directions(v: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision, scaled first so that nothing overflows."""
    scaled = v / np.abs(v).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a and the same row of b.

    Vectors of ordinary size are taken as they are; others are scaled to their largest component.
    """
    size = [np.abs(x).max(axis=1, keepdims=True) for x in (a, b)]
    a, b = (np.where((s > 1e-75) & (s < 1e75), x, x / s) for x, s in zip((a, b), size, strict=True))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


@dataclass
class Graph:
    """x: unit vectors by node, single precision; arcs: for each layer, lowest first, an array of node numbers, -1: none."""

    x: np.ndarray
    arcs: list[np.ndarray]

    def walk(self, layer: int, queries: np.ndarray, entry: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes nearest to each query and their similarities, best first; -1 where there are fewer."""
        arcs, count = self.arcs[layer], len(queries)
        nodes = np.full((count, breadth), -1, np.int32)
        near = np.full((count, breadth), -np.inf, np.float32)
        opened = np.ones((count, breadth), bool)
        begin = entry[:, :breadth]
        nodes[:, :begin.shape[1]], opened[:, :begin.shape[1]] = begin, begin < 0
        near[:, :begin.shape[1]] = np.where(begin < 0, -np.inf, np.einsum("qed,qd->qe", self.x[begin], queries))
        seen = np.zeros((count, len(arcs)), bool)
        rows, places = np.nonzero(begin >= 0)
        seen[rows, begin[rows, places]] = True
        order = np.argsort(-near, axis=1, kind="stable")
        nodes, near, opened = (np.take_along_axis(a, order, 1) for a in (nodes, near, opened))
        active = np.arange(count)
        while len(active):
            next_ones = np.argsort(opened[active], axis=1, kind="stable")[:, :STEP]  # the best not yet opened
            fresh = ~np.take_along_axis(opened[active], next_ones, 1)
            going = fresh[:, 0]
            active, next_ones, fresh = active[going], next_ones[going], fresh[going]
            if not len(active):
                break
            opened[active[:, None], next_ones] = True
            found = np.where(fresh[:, :, None], arcs[nodes[active[:, None], next_ones]], -1).reshape(len(active), -1)
            found.sort(axis=1)
            new = found >= 0
            new[:, 1:] &= found[:, 1:] != found[:, :-1]
            new &= ~seen[active[:, None], np.maximum(found, 0)]
            r, c = np.nonzero(new)
            seen[active[r], found[r, c]] = True
            like = np.full(found.shape, -np.inf, np.float32)
            like[r, c] = np.einsum("nd,nd->n", self.x[found[r, c]], queries[active[r]])
            every = np.concatenate([near[active], like], axis=1)
            best = np.argsort(-every, axis=1, kind="stable")[:, :breadth]
            near[active] = np.take_along_axis(every, best, 1)
            nodes[active] = np.take_along_axis(np.concatenate([nodes[active], found], axis=1), best, 1)
            opened[active] = np.take_along_axis(np.concatenate([opened[active], ~new], axis=1), best, 1)
        return np.where(np.isfinite(near), nodes, -1), near

    def descend(self, queries: np.ndarray, lowest: int, breadth: int = 4) -> np.ndarray:
        """Entry nodes of a layer: walks through all layers above it, from the first node."""
        entry = np.zeros((len(queries), 1), np.int32)
        for layer in range(len(self.arcs) - 1, lowest, -1):
            entry = self.walk(layer, queries, entry, breadth)[0]
        return entry

    def nearest(self, queries: np.ndarray, breadth: int = VIEW) -> np.ndarray:
        return self.walk(0, queries, self.descend(queries, 0), breadth)[0]


def diverse(x: np.ndarray, own: np.ndarray, nodes: np.ndarray, keep_arcs: int) -> np.ndarray:
    """Arcs chosen among each node's candidates: nearer to the node than to any one chosen before.

    Places left are filled with the best of the others.
    """
    like = np.where(nodes < 0, -np.inf, np.einsum("ncd,nd->nc", x[nodes], x[own]))
    order = np.argsort(-like, axis=1, kind="stable")
    nodes, like = np.take_along_axis(nodes, order, 1), np.take_along_axis(like, order, 1)
    vectors = x[nodes]
    between = vectors @ vectors.transpose(0, 2, 1)
    chosen = np.zeros(nodes.shape, bool)
    taken = np.zeros(len(nodes), np.int64)
    rival = np.full(nodes.shape, -np.inf, np.float32)  # similarity to the nearest one chosen
    for k in range(nodes.shape[1]):
        good = (nodes[:, k] >= 0) & (like[:, k] > rival[:, k]) & (taken < keep_arcs)
        chosen[good, k] = True
        taken += good
        rival[good] = np.maximum(rival[good], between[good, k])
    rank = np.where(chosen, 0, np.where(nodes >= 0, 1, 2))
    first = np.argsort(rank, axis=1, kind="stable")[:, :keep_arcs]
    return np.take_along_axis(nodes, first, 1)


def _distinct(nodes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Candidates without repeats and without the node itself, in rising order."""
    nodes = np.sort(np.where(nodes == own[:, None], -1, nodes), axis=1)
    nodes[:, 1:][nodes[:, 1:] == nodes[:, :-1]] = -1
    return nodes


def _add_back(graph: Graph, layer: int, source: np.ndarray, target: np.ndarray, keep_arcs: int) -> None:
    """Arcs target to source; lists without room are thinned to diverse ones."""
    arcs, width = graph.arcs[layer], graph.arcs[layer].shape[1]
    order = np.lexsort((-np.einsum("nd,nd->n", graph.x[source], graph.x[target]), target))
    source, target = source[order], target[order]
    heads, first, many = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, many)
    used = (arcs[heads] >= 0).sum(axis=1)
    fits = used + many <= width
    easy = np.repeat(fits, many)
    arcs[target[easy], np.repeat(used, many)[easy] + place[easy]] = source[easy]
    full = np.flatnonzero(~fits)
    for start in range(0, len(full), BATCH):
        part = full[start:start + BATCH]
        wide = np.full((len(part), min(int(many[part].max()), 2 * width)), -1, np.int32)  # the nearest new ones
        for row, k in enumerate(part):
            new = source[first[k]:first[k] + many[k]][:wide.shape[1]]
            wide[row, :len(new)] = new
        own = heads[part]
        better = diverse(graph.x, own, _distinct(np.concatenate([arcs[own], wide], axis=1), own), keep_arcs)
        arcs[own] = -1
        arcs[own[:, None], np.arange(better.shape[1])] = better


def _reach(arcs: np.ndarray) -> np.ndarray:
    """Which nodes a walk from the first node can come to."""
    reached, frontier = np.zeros(len(arcs), bool), np.zeros(1, np.int64)
    while len(frontier):
        reached[frontier] = True
        following = np.unique(arcs[frontier])
        following = following[following >= 0]
        frontier = following[~reached[following]]
    return reached


def _connect(graph: Graph, layer: int) -> None:
    """Arcs to nodes nobody reaches, from the nearest node that is reached; lists grow where there is no room."""
    while True:
        arcs = graph.arcs[layer]
        reached = _reach(arcs)
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return
        known = np.flatnonzero(reached)
        for start in range(0, len(lost), BATCH):
            part = lost[start:start + BATCH]
            hosts = known[(graph.x[part] @ graph.x[known].T).argmax(axis=1)]
            for node, host in zip(part, hosts, strict=True):
                arcs = graph.arcs[layer]
                used = int((arcs[host] >= 0).sum())
                if used == arcs.shape[1]:
                    arcs = graph.arcs[layer] = np.pad(arcs, ((0, 0), (0, SPARE)), constant_values=-1)
                arcs[host, used] = node


def make_graph(x: np.ndarray, levels: np.ndarray) -> Graph:
    """Graph of unit vectors whose levels fall from node to node."""
    top = int(levels[0])
    sizes = [int((levels >= layer).sum()) for layer in range(top + 1)]
    kept = [2 * ARCS] + [ARCS] * top
    graph = Graph(x, [np.full((n, k + SPARE), -1, np.int32) for n, k in zip(sizes, kept, strict=True)])
    done = 1
    while done < len(x):
        end = min(len(x), done + min(BATCH, done), *[n for n in sizes if n > done])  # one level at a time
        new, level = np.arange(done, end), int(levels[done])
        among = graph.x[new] @ graph.x[new].T
        np.fill_diagonal(among, -np.inf)
        entry = graph.descend(graph.x[new], level)
        for layer in range(level, -1, -1):
            entry = graph.walk(layer, graph.x[new], entry, BREADTH)[0]
            near = np.argsort(-among, axis=1, kind="stable")[:, :min(len(new) - 1, kept[layer])]
            candidates = _distinct(np.concatenate([entry, new[near].astype(np.int32)], axis=1), new)
            chosen = diverse(graph.x, new, candidates, kept[layer])
            graph.arcs[layer][new, :chosen.shape[1]] = chosen
            rows, places = np.nonzero(chosen >= 0)
            _add_back(graph, layer, new[rows], chosen[rows, places], kept[layer])
        done = end
    for layer in range(top + 1):
        _connect(graph, layer)
    return graph


def node_levels(count: int, seed: int) -> np.ndarray:
    """Levels of a shard's nodes, falling; each is ARCS times rarer than the one below."""
    chance = np.random.default_rng(seed).random(count)
    return np.sort(np.floor(-np.log(np.maximum(chance, 1e-12)) / np.log(ARCS)).astype(np.int64))[::-1]


INDEX = """shard int, length int, vectors array<double>, first array<int>, ids array<long>, copies array<long>,
           widths array<int>, nodes array<int>, arcs array<int>"""


def shard_row(rows: pd.DataFrame) -> pd.DataFrame:
    """The graph of a shard's rows (shard, vec_id, v, copies) as one row of flat arrays.

    Node k has the vector k, the ids from first[k] to first[k + 1] and, in a layer, the places
    from k times its width.
    """
    rows = rows.sort_values("vec_id", kind="stable")
    v = np.stack(rows["v"].to_numpy()).astype(np.float64) + 0.0  # no negative zeros
    _, at, node = np.unique(v.view(f"V{v.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
    shard = int(rows["shard"].iloc[0])
    mixed = np.random.default_rng(shard).permutation(len(at))  # np.unique sorts: no order to insert in
    at, number = at[mixed], np.argsort(mixed)[node]
    vectors = v[at]
    graph = make_graph(directions(vectors).astype(np.float32), node_levels(len(at), shard))
    by_node = np.argsort(number, kind="stable")
    return pd.DataFrame([{
        "shard": shard, "length": v.shape[1], "vectors": vectors.ravel(),
        "first": np.searchsorted(number[by_node], np.arange(len(at) + 1)).astype(np.int32),
        "ids": rows["vec_id"].to_numpy()[by_node], "copies": rows["copies"].to_numpy()[by_node],
        "widths": np.array([a.shape[1] for a in graph.arcs], np.int32),
        "nodes": np.array([a.shape[0] for a in graph.arcs], np.int32),
        "arcs": np.concatenate([a.ravel() for a in graph.arcs])}])


def build(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The index of all rows: a written table with the graph of each shard."""
    spark = rows.sparkSession
    own = usable(rows, vec_id, vector)
    lengths = own.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    length = lengths[0]["n"] if lengths else 1
    # Repeated rows are counted first, so that no shard is larger than its share of distinct ones.
    once = keep(own.where(F.size("v") == length).groupBy("vec_id", "v").agg(F.count("*").alias("copies")), "vectors")
    shards = max(1, round(once.count() / max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * length)))))
    dealt = once.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    with batches_of(spark, 1000):
        return keep(dealt.repartitionByRange(shards, "shard").groupBy("shard").applyInPandas(shard_row, INDEX), "graphs")


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside hand so many rows at a time to Python: graphs are large, one is enough."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shard_answers(row: pd.Series, ids: np.ndarray, queries: np.ndarray) -> pd.DataFrame:
    """(query_id, vec_id, score): the best rows of a shard for each query."""
    vectors = np.asarray(row["vectors"]).reshape(-1, row["length"])
    ends = np.cumsum([w * n for w, n in zip(row["widths"], row["nodes"], strict=True)])
    arcs = [a.reshape(n, w) for a, n, w in zip(np.split(np.asarray(row["arcs"]), ends[:-1]), row["nodes"], row["widths"], strict=True)]
    graph = Graph(directions(vectors).astype(np.float32), arcs)
    first, known, copies = (np.asarray(row[c]) for c in ("first", "ids", "copies"))
    answers = []
    for start in range(0, len(ids), BATCH):
        part, v = ids[start:start + BATCH], queries[start:start + BATCH]
        found = graph.nearest(directions(v).astype(np.float32))
        query, place = np.nonzero(found >= 0)
        node = found[query, place]
        score = cosines(v[query], vectors[node])
        # The query's own id may be among the first of a node, so one more is taken.
        many = np.minimum(first[node + 1] - first[node], NEAREST + 1)
        at = np.repeat(first[node], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        query, score, vec_id = np.repeat(query, many), np.repeat(score, many), known[at]
        times = np.where(vec_id == part[query], 0, np.minimum(copies[at], NEAREST))
        query, score, vec_id = (np.repeat(a, times) for a in (query, score, vec_id))
        order = np.lexsort((vec_id, -score, query))
        query, score, vec_id = query[order], score[order], vec_id[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        best = rank < NEAREST
        answers.append(pd.DataFrame({"query_id": part[query[best]], "vec_id": vec_id[best], "score": score[best]}))
    return pd.concat(answers) if answers else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def search(index: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the NEAREST rows found for each query, itself left out."""
    spark = index.sparkSession
    lengths = index.select("length").distinct().collect()
    length = lengths[0]["length"] if lengths else 1
    asked = keep(usable(queries, vec_id, vector).where(F.size("v") == length).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks = max(1, -(-asked.count() * 8 * (length + 1) // BLOCK_BYTES))
    made = []
    for block in range(blocks):
        chosen = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).orderBy("vec_id").toPandas()
        ids = chosen["vec_id"].to_numpy(np.int64)
        shared = spark.sparkContext.broadcast((ids, np.stack(chosen["v"]) if len(ids) else np.zeros((0, length))))

        def walked(graphs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in graphs:
                for _, row in batch.iterrows():
                    yield shard_answers(row, *shared.value)

        with batches_of(spark, 1):
            made.append(keep(index.mapInPandas(walked, "query_id long, vec_id long, score double"), "answers"))
        shared.destroy()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.unionByName, made).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= NEAREST).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

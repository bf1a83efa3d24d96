"""Filter audit, hard negatives and nearest neighbours against brute force on small rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from basketry.llm import filter_audit, hard_negatives, hnsw
from basketry.llm.common import prepare, table

DOCS = "doc_id long, text string, source string, part string, good int"
LABELS = "doc_id long, quality int, toxic int"
VECTORS = "vec_id long, embedding array<double>, label int, score string, v int"


def audited(spark, docs, labels):
    prepare(spark)
    made = filter_audit.audit_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    return {(r["part"], r["filter_order"], r["step"]): r for r in made.collect()}


def run_orders(docs, labels):
    """Every order applied to the rows one filter after the other."""
    smallest = {}
    for k, text, *_ in docs:
        if k is not None:
            smallest[text or ""] = min(k, smallest.get(text or "", k))
    failing = []
    for k, text, source, *_ in docs:
        text = text or ""
        words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
        failing.append((k, source or "", {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": k is not None and smallest[text] < k}))
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    out, credit = {}, {}
    for part in {p for _, p, _ in failing}:
        own = [(k, f) for k, p, f in failing if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = own
            for step, name in enumerate(order, 1):
                gone = [(k, f) for k, f in alive if f[name]]
                alive = [(k, f) for k, f in alive if not f[name]]
                out[part, order, step] = [
                    len(alive), len(gone), sum(f[name] for _, f in own) - len(gone),
                    sum(f[name] and sum(f.values()) == 1 for _, f in own),
                    sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone)]
                credit[part, name] = credit.get((part, name), 0) + len(gone)
    return {key: [*row, credit[key[0], key[1][key[2] - 1]]] for key, row in out.items()}


def test_filter_audit_runs_like_every_order(spark):
    plain = " ".join(f"word{k}" for k in range(60))
    docs = [(1, plain, "a"), (2, plain, "b"), (3, "short", None), (4, None, ""), (5, "", "a"), (6, "x y " * 40, "a"),
            (7, "ABC " * 5, "b"), (8, "$ " + plain, "a"), (None, plain, "a"), (None, "short", "b"), (9, plain, "a"), (9, plain, "a"),
            (1, plain, "a"), (10, plain.upper() + " # x", "b"), (11, "w\tw\nw " * 9000, "b")]
    labels = [(1, 1, 0), (2, 0, 1), (6, 1, 1), (6, 0, None), (9, 1, 0), (None, 1, 1), (99, 1, 1)]
    rows = audited(spark, [(*d, "clash", 7) for d in docs], labels)
    expected = run_orders(docs, labels)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {k: [r[n] for n in names] for k, r in rows.items()} == expected and len(expected) == 3 * 600
    assert audited(spark, [], labels) == {}
    assert audited(spark, [(1, plain, "a", "", 0)], [])["a", "ABCDE", 5]["kept"] == 1


def test_lattice_counts_every_order():
    edges = filter_audit.lattice("ABCDE")
    assert len(edges) == 80 and sum(w for _, _, w in edges) == 5 * math.factorial(5)
    assert all(w == math.factorial(bin(s).count("1")) * math.factorial(4 - bin(s).count("1")) for s, _, w in edges)
    with pytest.raises(ValueError, match="at most"):
        filter_audit.audit(None, "part", [], "ABCDEFG")


def vectors(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(k, v, label, "x", 1) for k, v, label in rows], VECTORS)


ODD = [(None, [1.0, 2.0, 3.0], 1), (9001, None, 1), (9002, [1.0, None, 2.0], 1), (9003, [float("nan"), 1.0, 1.0], 1),
       (9004, [float("inf"), 1.0, 1.0], 1), (9005, [], 1), (9006, [1.0], 1)]


def mined_by_force(rows):
    rows = [(k, [math.floor(256 * x) for x in v], label) for k, v, label in rows]
    out = set()
    for a, va, la in rows:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=True)), k, label) for k, v, label in rows if k != a)
        for p, positive, _ in [s for s in scored if s[2] == la][:5]:
            fits = [(k, n) for n, k, label in scored if label != la and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out |= {(a, positive, rank, k, -p, -n) for rank, (k, n) in enumerate(fits, 1)}
    return out


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_hard_negatives_against_brute_force(spark, scale):
    dice = random.Random(7)
    base = [[dice.gauss(0, 1) for _ in range(3)] for _ in range(12)]
    rows = []
    for k in range(150 if scale > 1 else 420):  # clusters, ties, zero vectors, opposite vectors
        v = [x + dice.choice([0, 0.02, 0.3]) * dice.gauss(0, 1) for x in dice.choice(base)]
        rows.append((k, [0.0] * 3 if k % 50 == 3 else [scale * round(x, 2) * (-1 if k % 60 == 5 else 1) for x in v], dice.randrange(3)))
    rows += [(1000 + k, rows[0][1], k % 3) for k in range(40)]
    odd = [*ODD, (9007, [1.0, 1.0, 1.0], None)]
    made = hard_negatives.mine(vectors(spark, rows + odd), F.col("vec_id") % 100 == 0).collect()
    assert {tuple(r) for r in made} == mined_by_force(rows) and len(made) == len(set(made))


def test_hard_negatives_of_few_rows(spark):
    anchor = F.col("vec_id") % 100 == 0
    assert hard_negatives.mine(vectors(spark, []), anchor).collect() == []
    assert hard_negatives.mine(vectors(spark, ODD[:5]), anchor).collect() == []
    assert hard_negatives.mine(vectors(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]), anchor).collect() == []
    # A repeated anchor is one anchor, a repeated candidate is ranked twice.
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (2, [0.9, 0.0], 2)]
    made = sorted(map(tuple, hard_negatives.mine(vectors(spark, rows), anchor).collect()))
    assert made == [(100, 1, 1, 2, 65536, 58880), (100, 1, 2, 2, 65536, 58880)]


def test_bounds_hold_for_every_row():
    dice = np.random.default_rng(3)
    for _ in range(40):
        v = np.floor(dice.normal(size=(60, 5)) * dice.choice([1, 300, 1e7]))
        a = v[:9]
        refs = hard_negatives.pick_references(v, 6)
        unit, norms = hard_negatives.unit(v)
        found = hard_negatives.angles(unit, refs)
        anchors = hard_negatives.Anchors(np.arange(9), np.zeros(9), a, norms[:9], found[:9])
        least, most = hard_negatives.bounds(anchors, found[20:30], norms[20:30])
        scored = a @ v[20:30].T
        assert (scored.min(axis=1) >= least).all() and (scored.max(axis=1) <= most).all()


def nearest_by_force(rows, step):
    v = np.array([r[1] for r in rows])
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    ids = np.array([r[0] for r in rows])
    out = {}
    for q in sorted({k for k in ids.tolist() if k % step == 0}):
        near = unit @ unit[ids.tolist().index(q)]
        out[q] = sorted((-round(s, 12), k) for s, k in zip(near.tolist(), ids.tolist(), strict=True) if k != q)[:5]
    return out


def test_nearest_neighbours_of_copies_and_few_rows(spark):
    dice = random.Random(5)
    rows = [(k, [dice.gauss(0, 1) for _ in range(4)], 0) for k in range(60)]
    rows += [(200 + k, rows[0][1], 0) for k in range(30)] + [(50, rows[50][1], 0), (7, rows[7][1], 0)]
    odd = [*ODD, (9000, [0.0] * 4, 0)]
    made = hnsw.search(hnsw.build(vectors(spark, rows + odd)), vectors(spark, rows + odd).where("vec_id % 50 = 0")).collect()
    found = {}
    for r in sorted(made, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((-round(r["score"], 12), r["vec_id"]))
    assert found == nearest_by_force(rows, 50)  # a graph this small is walked whole
    assert [k for _, k in found[0]] == [200, 201, 202, 203, 204]
    few = vectors(spark, [(0, [1.0, 0.0], 0), (1, [0.0, 2.0], 0), (2, [3e200, 0.0], 0)])
    made = hnsw.search(hnsw.build(few), few.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in made] == [(2, 1.0), (1, 0.0)]
    assert hnsw.search(hnsw.build(few.limit(0)), few).collect() == [] == hnsw.search(hnsw.build(few), few.limit(0)).collect()


def test_recall_over_several_shards(spark, folder, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 60)
    rows = table(prepare(spark), folder.replace("sf0.001", "sf0.01"), "embeddings")
    index = hnsw.build(rows)
    assert index.count() > 4
    made = {(r["query_id"], r["vec_id"]) for r in hnsw.search(index, rows.where("vec_id % 5 = 0")).collect()}
    truth = nearest_by_force([(r["vec_id"], r["embedding"]) for r in rows.collect()], 5)
    right = {(q, k) for q, near in truth.items() for _, k in near}
    assert len(made) == len(right) and len(made & right) >= 0.95 * len(right)


def test_graph_reaches_every_node():
    dice = np.random.default_rng(1)
    tight = np.concatenate([c + 1e-4 * dice.normal(size=(150, 8)) for c in dice.normal(size=(8, 8))])
    x = hnsw.directions(tight).astype(np.float32)
    graph = hnsw.make_graph(x, hnsw.node_levels(len(x), 0))
    assert all(hnsw._reach(arcs).all() for arcs in graph.arcs) and len(graph.arcs) > 1
    found = graph.nearest(x[::10])[:, 0]
    assert np.mean(np.einsum("nd,nd->n", x[found], x[::10]) > 1 - 1e-5) == 1


def test_registered(spark, folder):
    made = entry_points.queries()["op13_nearest_neighbours"](spark, folder)
    assert dict(made.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"} and made.count() > 0


def test_pipeline_stages_keep_rows_apart_by_text(spark):
    other = " ".join(f"garden{k}" for k in range(40))
    plain = "the quick brown fox and the lazy dog were in the garden with a friend of the old man by the river"
    rows = [(1, plain, "a"), (1, other, "b"), (2, plain + " and", "c"), (None, "one two three four five six seven", "d"),
            (None, "one two three four five six seven", "e"), (None, None, "f"), (3, "", "g"), (3, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __stays string")
    near = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, None)
    assert near.columns == docs.columns
    assert sorted(r["__stays"] for r in near.collect()) == ["a", "b", "d", "f", "g", "h"]

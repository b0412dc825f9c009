"""The tree against brute force."""

from __future__ import annotations

import math

import numpy as np
from conftest import FOLDER
from pyspark.sql import functions as F

from plateflow.llm import ann
from plateflow.llm.queries import QUERIES

BIGGER = FOLDER.replace("sf0.001", "sf0.1")


def brute(rows, k=5):
    ids, vectors = [i for i, _ in rows], np.array([v for _, v in rows], float)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for place, i in enumerate(ids):
        if i % 50 == 0:
            scores = units @ units[place]
            out[i] = sorted((-round(float(s), 12), j) for s, j in zip(scores, ids) if j != i)[:k]
    return out


def test_recall(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{BIGGER}/embeddings.parquet").collect()]
    true = brute(rows)
    got = {}
    for r in QUERIES["op7_nearest_neighbours"](spark, BIGGER).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == true.keys()
    units = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in rows}
    hits = 0
    for i, found in got.items():
        assert sorted(rank for rank, _, _ in found) == [1, 2, 3, 4, 5]
        assert [(-s, j) for _, j, s in sorted(found)] == sorted((-s, j) for _, j, s in found)
        assert all(math.isclose(s, float(units[i] @ units[j]), abs_tol=1e-12) for _, j, s in found)
        hits += len({j for _, j, _ in found} & {j for _, j in true[i]})
    assert hits >= 0.93 * 5 * len(true)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0]), (None, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0])]
    rows += [(i, [2.0, 0.0]) for i in range(101, 140)] + [(8, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double")
    got = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 9)) for r in ann.neighbours(df, F.col("vec_id") % 50 == 0).collect()}
    assert {got[0, n] for n in range(1, 6)} == {(i, 1.0) for i in range(101, 106)} and [got[0, n][0] for n in range(1, 6)] == list(range(101, 106))
    assert [got[50, n][0] for n in range(1, 6)] == [0, 101, 102, 103, 104] and len(got) == 10
    few = ann.neighbours(df.where("vec_id in (0, 8, 50)"), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few) == [(0, 1, 50), (0, 2, 8), (50, 1, 0), (50, 2, 8)]
    assert ann.neighbours(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.neighbours(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_visits_are_best_first():
    rng = np.random.default_rng(1)
    units = rng.normal(size=(3000, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    tree = ann.fit(units)
    leaves = tree.assign(units)
    assert ann.LEAVES <= tree.leaves < ann.LEAVES + ann.BRANCHES and set(leaves) == set(range(tree.leaves))
    assert ann.fit(units[:1]).leaves == 1 and ann.fit(np.repeat(units[:1], 50, axis=0)).leaves == 1
    for unit, leaf in zip(units[:50], leaves):
        order = tree.visits(unit, tree.leaves)
        assert order[0] == leaf and sorted(order) == list(range(tree.leaves))


def test_visits_go_on_until_there_are_enough():
    rng = np.random.default_rng(2)
    units = rng.normal(size=(2000, 6))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    tree = ann.fit(units)
    sizes = np.bincount(tree.assign(units), minlength=tree.leaves)
    for unit in units[:20]:
        more = tree.visits(unit, 1, sizes, 40)
        assert more == tree.visits(unit, len(more)) and sum(sizes[more]) >= 40 > sum(sizes[more[:-1]])


def test_tight_clusters_still_give_five(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(300, 8))
    rows = [(50 * n + m, (centres[n] + 0.001 * rng.normal(size=8)).tolist()) for n in range(300) for m in range(2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.neighbours(df, F.col("vec_id") % 50 == 0, recall=0.2).groupBy("query_id").count().collect()
    assert len(got) == 300 and {r["count"] for r in got} == {5}

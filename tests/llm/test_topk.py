"""The greatest inner products against all of them."""

from __future__ import annotations

import numpy as np
import pytest
from compare import differences, open_tables
from conftest import FOLDER
from pyspark.sql import functions as F

from plateflow.llm import topk
from plateflow.llm.queries import ORACLES, QUERIES


def plain(ids, vectors, asked, k):
    """Per asked id, (score, id) of the k best, with Python's integers."""
    whole = [[int(x) for x in row] for row in np.floor(vectors).tolist()]
    out = {}
    for i, own in zip(ids, whole):
        if i in asked:
            scored = sorted((-sum(a * b for a, b in zip(own, other)), j) for j, other in zip(ids, whole) if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


@pytest.mark.parametrize("size, spread", [(64, 20.0), (5, 2.0), (1, 3.0), (33, 1e3), (3, 1e12)])
def test_search(size, spread):
    rng = np.random.default_rng(size)
    vectors = np.floor(rng.normal(size=(400, size)) * spread * rng.exponential(size=(400, 1)))
    vectors[200:260] = vectors[7]  # ties
    ids = np.arange(400) * 3
    search = topk.Search(ids[::20], vectors[::20], 6)
    for start in range(0, 400, 90):
        search.add(ids[start : start + 90], vectors[start : start + 90])
    got = {}
    for query, found, score in zip(*[column.to_pylist() for column in search.best().columns]):
        got.setdefault(query, []).append((found, score))
    high = 2**63 - 1
    expected = plain(ids.tolist(), vectors, set(ids[::20].tolist()), 6)
    assert got == {i: [(j, max(min(s, high), -high - 1)) for j, s in rows] for i, rows in expected.items()}


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(2)
    left, right = (np.floor(rng.normal(size=(50, 48)) * 30) for _ in range(2))
    exact, before = left @ right.T, None
    for starts in topk.levels(48):
        bound = topk.statistics(left, starts) @ topk.statistics(right, starts).T
        assert (bound >= exact - 1e-6).all()
        assert before is None or bound.mean() <= before.mean() + 1e-6
        before = bound
    assert [len(starts) for starts in topk.levels(48)] == [1, 4, 16] and topk.levels(0) == topk.levels(1) == []


def test_few_pairs_are_multiplied():
    """With vectors in groups, bounds leave little to multiply."""
    rng = np.random.default_rng(4)
    centres = np.repeat(rng.normal(size=(40, 16)), 4, axis=1) * 60
    vectors = np.floor(centres[rng.integers(40, size=8000)] + rng.normal(size=(8000, 64)) * 2)
    search = topk.Search(np.arange(100), vectors[:100], 20)
    search.add(np.arange(8000), vectors)
    assert search.multiplied < 0.3 * 100 * 8000


def test_query(spark):
    assert differences(QUERIES["op12_exact_top_k"](spark, FOLDER), open_tables(FOLDER), ORACLES["op12_exact_top_k"]) is None


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 1.0]), (20, [1.0, 1.0]), (20, [2.0, 1.0]), (None, [9.0, 0.0]), (1, None), (2, []), (40, []), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [1e308, 1.0]), (9, [0.0, 0.0]), (10, [-0.01, 0.5]), (11, [0.5, 0.0]), (11, [0.25, 0.0])]
    rows += [(i, [2.0, 0.0]) for i in range(101, 140) if i % 20] * 2
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    # Of an id with several vectors the least asks, and the best is found, once.
    assert got[0] == {n: (i, 8192) for n, i in enumerate([20, *[i for i in range(101, 140) if i % 20][:19]], 1)}
    assert got[20][1] == (101, 8192) and len(got[20]) == 20 and 40 in got and got[40] == {1: (2, 0)}
    assert set(got) == {0, 20, 40}
    few = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df.where("vec_id in (0, 9, 10, 11)"), F.col("vec_id") % 20 == 0).collect()}
    assert few == {(0, 1): (11, 2048), (0, 2): (9, 0), (0, 3): (10, -64)}
    assert topk.top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0

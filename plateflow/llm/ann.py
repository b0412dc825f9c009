"""Approximate nearest neighbours by cosine in a hierarchical k-means tree.

The tree is fitted on a bounded sample (`SAMPLE` vectors by a hash of their ids) and then every vector is put into a leaf.
A query visits leaves best bin first: a priority queue holds the branches passed by, the nearest next. How many leaves a
query visits is calibrated: for some queries (`CALIBRATION`) the true neighbours are found by a scan of all vectors, and
visits are widened until the leaves visited hold the wanted share of them; and those of a query go on until its leaves hold k
others. Nodes are split largest first until there are `LEAVES`, however many vectors there are: visits grow with the queries only,
and the work in a leaf is that of two matrices.

Equal vectors are one entry with its least ids, as many as can be answers, so a vector that is very common costs no more
than another. Leaves are cut into blocks of bounded size, and so are the queries that visit one, so no task holds a whole
leaf. Scores are cosines in double precision of the original vectors.

Defined results: null ids, and vectors that are null, zero, empty or hold null or non-finite components take no part, nor
do vectors whose length is not the most common one; repeated rows count once; if an id has several vectors, its
query uses the least of them and as an answer it appears once, with its best score; no vectors, no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.session import written

#: Vectors that the tree is fitted on, at most.
SAMPLE = 20_000
#: Leaves of the tree, about, and branches of a node.
LEAVES, BRANCHES = 256, 8
#: Queries whose true neighbours are found for calibration, and the share of them that the visited leaves must hold.
CALIBRATION, RECALL = 200, 0.97
#: Vectors, and queries, that are compared at once.
BLOCK = 256


@dataclass(frozen=True)
class Tree:
    """Centres of the nodes, children of each (none: a leaf) and the leaf's number."""

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]
    leaf: tuple[int, ...]

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def assign(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: down to the nearest child."""
        out = np.zeros(len(units), np.int32)
        todo = [(0, np.arange(len(units)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
            elif len(rows):
                own = np.array(self.children[node])
                nearest = (units[rows] @ self.centres[own].T).argmax(axis=1)
                todo += [(child, rows[nearest == i]) for i, child in enumerate(own)]
        return out

    def visits(self, unit: np.ndarray, number: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first leaves, best bin first; more of them while they hold fewer than `least` by their `sizes`."""
        near = self.centres @ unit
        queue, found, held = [(-near[0], 0)], [], 0
        while queue and (len(found) < number or held < least):
            node = heapq.heappop(queue)[1]
            while self.children[node]:
                best, *others = sorted(self.children[node], key=lambda child: (-near[child], child))
                for child in others:
                    heapq.heappush(queue, (-near[child], child))
                node = best
            found.append(self.leaf[node])
            held += sizes[self.leaf[node]] if sizes is not None else 0
        return found


def fit(units: np.ndarray, seed: int = 7) -> Tree:
    """A tree of LEAVES leaves and some, or as many as the unit vectors can be told apart by; the largest node is split first."""
    rng = np.random.default_rng(seed)
    centres, children, leaf, leaves = [_unit(units.mean(axis=0, keepdims=True))[0]], [()], [-1], 0
    todo = [(-len(units), 0, np.arange(len(units)))]
    while todo:
        _, node, rows = heapq.heappop(todo)
        parts = _kmeans(units[rows], BRANCHES, rng) if leaves + len(todo) + 1 < LEAVES and len(rows) > 1 else []
        if len(parts) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        first = len(centres)
        children[node] = tuple(range(first, first + len(parts)))
        for centre, inside in parts:
            centres.append(centre)
            children.append(())
            leaf.append(-1)
            heapq.heappush(todo, (-len(inside), len(centres) - 1, rows[inside]))
    return Tree(np.array(centres), tuple(children), tuple(leaf))


def _kmeans(units: np.ndarray, k: int, rng, rounds: int = 12) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spherical k-means: (centre, rows) of each cluster that has rows."""
    centres = units[rng.choice(len(units), min(k, len(units)), replace=False)]
    for _ in range(rounds):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        kept = np.bincount(nearest, minlength=len(centres)) > 0
        centres = _unit(sums[kept])
    nearest = (units @ centres.T).argmax(axis=1)
    return [(centre, rows) for i, centre in enumerate(centres) if len(rows := np.flatnonzero(nearest == i))]


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    scaled = vectors / np.maximum(np.abs(vectors).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return scaled / np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), np.finfo(float).tiny)


def _matrix(column) -> np.ndarray:
    values = column.flatten() if isinstance(column, pa.Array) else None
    if values is not None:
        return values.to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    return np.stack(column.to_numpy()).astype(float)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _best(queries: np.ndarray, query_ids, own: np.ndarray, ids: list, k: int) -> pd.DataFrame:
    """The k best answers to each query among the entries, each entry standing for several ids."""
    out = []
    q, v = _unit(queries), _unit(own)
    near = q @ v.T
    width = min(k + 1, len(v))  # one entry may be the query's own
    top = np.argpartition(-near, width - 1, axis=1)[:, :width]
    limit = np.take_along_axis(near, top, axis=1).min(axis=1) - 1e-12  # entries that tie with the last one stay
    for row, query in enumerate(query_ids):
        picked = np.flatnonzero(near[row] >= limit[row])
        scores = (v[picked] * q[row]).sum(axis=1)
        found = sorted((-score, i) for score, entry in zip(scores, picked) for i in ids[entry] if i != query)[:k]
        out += [(query, i, -score) for score, i in found]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


_FOUND = "query_id long, vec_id long, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def neighbours(vectors: DataFrame, query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of all vectors to those for which `query` holds, but not themselves.

    `query` is a condition on the column `id` of the result's vectors, named `vec_id` here.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == lengths[0]["size"])

    # Entries: each distinct vector with its k + 1 least ids; the limit acts before the shuffle.
    within = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.dropDuplicates(["vec_id", "vector"]).withColumn("n", F.row_number().over(within)).where(F.col("n") <= k + 1)
    entries = written(least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-entries")
    queries = written(rows.where(query).groupBy("vec_id").agg(F.min("vector").alias("vector")), "ann-queries")

    sample = entries.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE).select("vector").toPandas()
    tree = fit(_unit(_matrix(sample["vector"])))
    sent = spark.sparkContext.broadcast(tree)

    def to_leaves(batches):
        for batch in batches:
            leaf = sent.value.assign(_unit(_matrix(batch.column(0)))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], ["vector", "ids", "leaf"])

    placed = written(entries.mapInArrow(to_leaves, "vector array<double>, ids array<long>, leaf int"), "ann-leaves")
    number = _calibrated(placed, queries, tree, k, recall)
    # One row per leaf. An entry is one id at least, and one of them may be the query's own.
    held = {row["leaf"]: row["n"] for row in placed.groupBy("leaf").agg(F.sum(F.size("ids")).alias("n")).collect()}
    held = np.array([held.get(leaf, 0) for leaf in range(tree.leaves)])

    def to_visits(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            visited = [sent.value.visits(unit, number, held, k + 1) for unit in _unit(_matrix(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(visited, pa.list_(pa.int32()))], ["vec_id", "vector", "leaves"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    visits = queries.repartition(tasks, "vec_id").mapInArrow(to_visits, "vec_id long, vector array<double>, leaves array<int>")
    visits = written(visits.select("vec_id", "vector", F.explode("leaves").alias("leaf")), "ann-visits")

    # Blocks of each leaf and of its queries; every pair of them is one piece of work.
    blocks = lambda df: df.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n"))
    sizes = blocks(placed).withColumnRenamed("n", "blocks").join(blocks(visits).withColumnRenamed("n", "sets"), "leaf")
    sizes = F.broadcast(sizes)  # a row per leaf
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(sizes, "leaf").select("leaf", F.pmod(F.xxhash64("ids"), F.col("blocks")).cast("int").alias("block"), numbers("sets").alias("set"), "vector", "ids")
    right = visits.join(sizes, "leaf").select("leaf", numbers("blocks").alias("block"), F.pmod(F.xxhash64("vec_id"), F.col("sets")).cast("int").alias("set"), "vector", "vec_id")

    def compare(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asked):
            return _best(np.zeros((0, 1)), [], np.zeros((1, 1)), [[]], k)
        return _best(_matrix(asked["vector"]), asked["vec_id"].tolist(), _matrix(own["vector"]), own["ids"].tolist(), k)

    key = ["leaf", "block", "set"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, _FOUND)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def _calibrated(placed: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float) -> int:
    """How many leaves hold the wanted share of the true neighbours of some queries."""
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).toPandas()
    if not len(some):
        return 1
    asked, ids = _matrix(some["vector"]), some["vec_id"].tolist()
    sent = placed.sparkSession.sparkContext.broadcast((asked, ids))

    def scan(frames):
        for frame in frames:
            if len(frame):
                best = _best(*sent.value, _matrix(frame["vector"]), frame["ids"].tolist(), k)
                leaf = {i: leaf for own, leaf in zip(frame["ids"], frame["leaf"]) for i in own}
                yield best.assign(leaf=best["vec_id"].map(leaf).astype("int32"))

    found = placed.mapInPandas(scan, _FOUND + ", leaf int")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").collect()  # k rows a query
    visits = {i: {leaf: n for n, leaf in enumerate(tree.visits(unit, tree.leaves), 1)} for i, unit in zip(ids, _unit(asked))}
    needed = sorted(visits[row.query_id][row.leaf] for row in true)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 1

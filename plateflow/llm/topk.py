"""The k greatest inner products of integer vectors, exact, by bounds from means and deviations of segments.

A vector is cut into segments, a few long ones first and ever more short ones. Of a segment of length l with means m, m'
and deviations s, s' the squared distance is at least l (m - m')^2 + l (s - s')^2, so the inner product of two vectors,
half of their squared lengths less their distance, is at most the sum of l (m m' + s s'). Level by level these bounds are
held against the k-th best score that a query has so far; only what no level rules out is multiplied in full.

Queries are dealt to blocks of about `QUERIES`, and every candidate meets each block in one of `STRIPES` tasks, which
streams candidates in the order of their ids past the block: it holds one block of either. Thus later candidates have to
beat the k-th score, not equal it. A task hands on k rows a query. Work grows with queries times candidates, shuffled data
with candidates times blocks of queries.

Defined results: null ids, and vectors that are null or hold null or non-finite components take no part (scaled components
beyond a double are non-finite); inner products are of vectors of equal length, so a query finds those of its own length;
empty vectors score 0; repeated rows count once; an id with several vectors asks with the least of them and is found once,
with its best score; scores beyond 64 bits rank exactly and are reported as the 64-bit number next to them; no vectors, no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateflow.session import written

#: Queries of a block, about, and candidates that are compared with it at once.
QUERIES, CANDIDATES = 1024, 256
#: Tasks that share the candidates of a block of queries.
STRIPES = 8
#: Segments are cut into so many at each level.
FINER = 4
#: Pairs that are multiplied one by one at once; while a greater share of all is left, whole matrices are.
PAIRS, DENSE = 1 << 16, 1 / 8

_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def levels(size: int) -> list[np.ndarray]:
    """Where the segments begin, from one segment up to segments of two components."""
    starts, number = [], 1
    while 2 * number <= size:
        starts.append(np.arange(number) * size // number)
        number *= FINER
    return starts


def statistics(vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Means and deviations of the segments, each times the root of its length: their products are the bounds."""
    lengths = np.diff(np.append(starts, vectors.shape[1]))
    means = np.add.reduceat(vectors, starts, axis=1) / lengths
    squares = np.add.reduceat((vectors - np.repeat(means, lengths, axis=1)) ** 2, starts, axis=1)
    return np.hstack((means * np.sqrt(lengths), np.sqrt(squares)))


class Search:
    """The best candidates of a block of queries so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [(starts, statistics(vectors, starts)) for starts in levels(vectors.shape[1])]
        self.norms = np.sqrt((vectors**2).sum(axis=1))
        self.largest = float(np.abs(vectors).max(initial=0))
        # Rows (query, candidate, score) by query, best first.
        self.rows = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.limit = np.full(len(ids), -np.inf)
        self.multiplied = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Candidates whose ids are not below those before."""
        for start in range(0, len(ids), CANDIDATES):
            self._block(ids[start : start + CANDIDATES], vectors[start : start + CANDIDATES])

    def _block(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        fits = float(np.abs(vectors).max(initial=0)) * self.largest * max(1, vectors.shape[1]) < 2**53
        pairs = _Pairs(self.ids[:, None] != ids[None, :])
        # Scores are whole numbers: a better one is at least one more. The rest is for rounding.
        wanted = self.limit + 1 - 1e-9 * (1 + self.norms * np.sqrt((vectors**2).sum(axis=1)).max(initial=0))
        if np.isfinite(wanted).any():
            for starts, own in self.levels:
                pairs.keep(own, statistics(vectors, starts), wanted)
        self.multiplied += pairs.number
        query, found, score = pairs.better(self.vectors, vectors, self.limit, fits, self.k if len(np.unique(ids)) == len(ids) else None)
        if len(query):
            self._merge(query, ids[found], score)

    def _merge(self, query: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        query, found = np.concatenate((self.rows[0], query)), np.concatenate((self.rows[1], found))
        score = np.concatenate((self.rows[2], score))
        order = np.lexsort((-score, found, query))
        query, found, score = query[order], found[order], score[order]
        single = np.ones(len(query), bool)
        single[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1])
        query, found, score = query[single], found[single], score[single]
        order = np.lexsort((found, -score, query))
        query, found, score = query[order], found[order], score[order]
        first = np.searchsorted(query, np.arange(len(self.ids)))
        kept = np.arange(len(query)) - first[query] < self.k
        self.rows = query, found, score = query[kept], found[kept], score[kept]
        full = np.flatnonzero(np.bincount(query, minlength=len(self.ids)) == self.k)
        last = np.searchsorted(query, full, side="right") - 1
        self.limit[full] = score[last].astype(float)

    def best(self) -> pa.RecordBatch:
        low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        scores = [min(max(int(s), low), high) for s in self.rows[2].tolist()]
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.rows[0]]), pa.array(self.rows[1]), pa.array(scores, pa.int64())], schema=_FOUND)


class _Pairs:
    """Pairs of queries and candidates that may matter: a matrix while they are many, then a list."""

    def __init__(self, may: np.ndarray):
        self.may, self.listed = may, None
        self._count()

    def _count(self) -> None:
        self.number = int(np.count_nonzero(self.may)) if self.listed is None else len(self.listed[0])
        if self.listed is None and self.number <= self.may.size * DENSE:
            self.listed = np.nonzero(self.may)

    def _products(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Inner products of the listed pairs."""
        query, found = self.listed
        cuts = range(0, len(query), PAIRS)
        parts = [np.einsum("ij,ij->i", left[query[at : at + PAIRS]], right[found[at : at + PAIRS]]) for at in cuts]
        return np.concatenate(parts) if parts else np.zeros(0)

    def keep(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> None:
        """Only pairs whose inner product is at least that of their query."""
        if self.listed is None:
            self.may &= left @ right.T >= least[:, None]
        else:
            held = self._products(left, right) >= least[self.listed[0]]
            self.listed = self.listed[0][held], self.listed[1][held]
        self._count()

    def better(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray, fits: bool, k: int | None) -> tuple:
        """(query, candidate, score) of the pairs whose inner product is beyond that of their query; the k best will do."""
        if self.listed is None and fits:
            scores = np.where(self.may, left @ right.T, -np.inf)
            held = self.may & (scores > limit[:, None])
            if k is not None and scores.shape[1] > k:
                held &= scores >= np.partition(scores, -k, axis=1)[:, -k, None]
            query, found = np.nonzero(held)
            return query, found, scores[query, found]
        query, found = np.nonzero(self.may) if self.listed is None else self.listed
        self.listed = query, found
        scores = self._products(left, right) if fits else _exact(left, right, self.listed)
        held = np.flatnonzero(scores > limit[query])
        return query[held], found[held], scores[held]


def _exact(left: np.ndarray, right: np.ndarray, pairs: tuple) -> np.ndarray:
    """Inner products as Python integers, for components whose products a double cannot hold."""
    whole = [[[int(x) for x in row] for row in rows.tolist()] for rows in (left, right)]
    scores = np.empty(len(pairs[0]), object)
    for place, (i, j) in enumerate(zip(*[side.tolist() for side in pairs])):
        scores[place] = sum(a * b for a, b in zip(whole[0][i], whole[1][j]))
    return scores


def _matrix(column: pa.Array, size: int, scale: float) -> np.ndarray:
    return np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), size))


def _search(batches: Iterator[pa.RecordBatch], k: int, scale: float) -> Iterator[pa.RecordBatch]:
    """Batches by (size, block, stripe), the queries of each first."""
    key, asked, search = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = [batch.column(name).to_numpy() for name in ("size", "block", "stripe", "candidate")]
        changes = np.flatnonzero(np.any([mark[1:] != mark[:-1] for mark in marks], axis=0)) + 1
        for start, end in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
            size, block, stripe, candidate = (int(mark[start]) for mark in marks)
            if (size, block, stripe) != key:
                if search:
                    yield search.best()
                key, asked, search = (size, block, stripe), [], None
            part = batch.slice(start, end - start)
            ids, vectors = part.column("vec_id").to_numpy(), _matrix(part.column("vector"), size, scale)
            if not candidate:
                asked.append((ids, vectors))
            elif asked:
                search = search or Search(np.concatenate([a[0] for a in asked]), np.concatenate([a[1] for a in asked]), k)
                search.add(ids, vectors)
    if search:
        yield search.best()


def top_k(vectors: DataFrame, query: Column, k: int = 20, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of greatest inner product with each row for which `query` holds.

    Components count as whole numbers, `floor(scale * x)`. Ties go to the smaller id; no query finds itself. `query` is a
    condition on the column `id`, named `vec_id` here.
    """
    spark = vectors.sparkSession
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x * scale) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    # Copies of a row go before they are shuffled.
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).dropDuplicates(["vec_id", "vector"])
    rows = written(rows.withColumn("size", F.size("vector")), "topk-vectors")
    queries = rows.where(query).groupBy("vec_id", "size").agg(F.min("vector").alias("vector"))
    # The least of an id's vectors, whatever their lengths.
    queries = queries.groupBy("vec_id").agg(F.min(F.struct("vector", "size")).alias("_least")).select("vec_id", "_least.*")
    queries = written(queries, "topk-queries")
    blocks = max(1, -(-queries.count() // QUERIES))

    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select("size", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), numbers(STRIPES).alias("stripe"), F.lit(0).alias("candidate"), "vec_id", "vector")
    stripe = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(STRIPES)).cast("int")
    others = rows.select("size", numbers(blocks).alias("block"), stripe.alias("stripe"), F.lit(1).alias("candidate"), "vec_id", "vector")
    key = ["size", "block", "stripe"]
    # A number of tasks is given, since their work is in the products and not in the bytes that they read.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), STRIPES)
    met = asked.unionByName(others).repartition(tasks, *key).sortWithinPartitions(*key, "candidate", "vec_id")
    found = met.mapInArrow(lambda batches: _search(batches, k, scale), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    single = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

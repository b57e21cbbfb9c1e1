"""Approximate nearest neighbours with one vantage-point tree per shard.

A node keeps a vantage vector and, for its inner and outer half, the range of their
distances to it. By the triangle inequality a half is no nearer to a query than the gap
between the query's own distance to the vantage vector and that range. A half is skipped
if ``factor`` times the gap exceeds the distance of the worst neighbour so far: factor one
skips only what cannot matter (exact search), a larger one trades recall for time.

Rows are dealt to shards by a hash of their id. Every query is sent to every shard; tasks
hold the tree of one shard and let its queries stream past in blocks. The number of
shards grows with the rows, the tree in a task does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areakit.llm.common import map_batches, only
from areakit.session import settle

NEIGHBOURS = 10
FACTOR = 2.0
SHARD_ROWS = 65_536
LEAST_SHARDS = 12
LEAF = 48
QUERY_BLOCK = 256


class VantageTree:
    """A tree over the rows of ``vectors``; rows equal in all components stay at most ``same``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, same: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order] + 0.0  # -0.0 and 0.0 are one value
        if len(ids):
            rows = np.ascontiguousarray(vectors).view([("", "V8")] * vectors.shape[1]).ravel()
            _, group = np.unique(rows.view(f"V{8 * vectors.shape[1]}"), return_inverse=True)
            by_group = np.argsort(group, kind="stable")  # within a group by id
            starts = np.flatnonzero(np.diff(group[by_group], prepend=-1))
            rank = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
            kept = np.sort(by_group[rank < same])
            ids, vectors = ids[kept], vectors[kept]
        self.order = np.arange(len(ids))
        self.nodes: list[tuple] = []  # (low, high) of a leaf or (vantage, inner, outer, ranges)
        self._all, self._ids = vectors, ids
        self.root = self._build(0, len(ids), np.random.default_rng(11))
        self.vectors, self.ids = vectors[self.order], ids[self.order]
        self.squares = (self.vectors**2).sum(axis=1)
        del self._all, self._ids

    def _build(self, low: int, high: int, random: np.random.Generator) -> int:
        number = len(self.nodes)
        self.nodes.append((low, high))
        if high - low > LEAF:
            pick = int(random.integers(low, high))
            self.order[[low, pick]] = self.order[[pick, low]]
            rest = self.order[low + 1 : high]
            gaps = np.sqrt(((self._all[rest] - self._all[self.order[low]]) ** 2).sum(axis=1))
            by_gap = np.argsort(gaps, kind="stable")
            self.order[low + 1 : high], gaps = rest[by_gap], gaps[by_gap]
            half = len(gaps) // 2
            inner = self._build(low + 1, low + 1 + half, random)
            outer = self._build(low + 1 + half, high, random)
            self.nodes[number] = (low, inner, outer, (gaps[0], gaps[half - 1]), (gaps[half], gaps[-1]))
        return number

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        """Distances and ids of the ``k`` nearest rows per query, nearest first, then by id.

        Missing ones have an infinite distance. The row with a query's own id is left out.
        """
        state = _Search(self, query_ids, queries, k, factor)
        everyone = np.arange(len(queries))
        if len(self.ids):
            state.descend(self.root, everyone)  # the nearest leaf first, for a close bound
            state.visit(self.root, everyone)
        return state.gaps, state.found


class _Search:
    def __init__(self, tree: VantageTree, query_ids, queries, k: int, factor: float):
        self.tree, self.own, self.queries, self.factor = tree, query_ids, queries, factor
        self.squares = (queries**2).sum(axis=1)
        self.gaps = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.home = np.full(len(queries), -1)

    def distance(self, active: np.ndarray, row: int) -> np.ndarray:
        return np.sqrt(((self.queries[active] - self.tree.vectors[row]) ** 2).sum(axis=1))

    def offer(self, active: np.ndarray, low: int, high: int) -> None:
        """Compare rows ``low`` to ``high`` with the active queries."""
        if not len(active):
            return
        product = self.queries[active] @ self.tree.vectors[low:high].T
        near = self.squares[active, None] + self.tree.squares[low:high] - 2 * product
        bound = self.gaps[active, -1] ** 2 * (1 + 1e-9) + 1e-9 * (1 + self.squares[active])
        close = (near <= bound[:, None]) & (self.own[active, None] != self.tree.ids[low:high])
        for i in np.flatnonzero(close.any(axis=1)).tolist():
            query, rows = active[i], low + np.flatnonzero(close[i])
            exact = np.sqrt(((self.queries[query] - self.tree.vectors[rows]) ** 2).sum(axis=1))
            gaps = np.concatenate([self.gaps[query], exact])
            ids = np.concatenate([self.found[query], self.tree.ids[rows]])
            best = np.lexsort((ids, gaps))[: self.gaps.shape[1]]
            self.gaps[query], self.found[query] = gaps[best], ids[best]

    def descend(self, number: int, active: np.ndarray) -> None:
        node = self.tree.nodes[number]
        if not len(active):
            return
        if len(node) == 2:
            self.home[active] = number
            self.offer(active, *node)
            return
        vantage, inner, outer, (_, inner_high), (outer_low, _) = node
        inside = self.distance(active, vantage) <= (inner_high + outer_low) / 2
        self.descend(inner, active[inside])
        self.descend(outer, active[~inside])

    def visit(self, number: int, active: np.ndarray) -> None:
        node = self.tree.nodes[number]
        if not len(active):
            return
        if len(node) == 2:
            self.offer(active[self.home[active] != number], *node)
            return
        vantage, inner, outer, *ranges = node
        self.offer(active, vantage, vantage + 1)
        gap = self.distance(active, vantage)
        for child, (least, most) in zip((inner, outer), ranges):
            apart = np.maximum(np.maximum(least - gap, gap - most), 0)
            self.visit(child, active[self.factor * apart <= self.gaps[active, -1] + 1e-9])


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _searcher(k: int, factor: float):
    def answer(tree: VantageTree, ids: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(ids), QUERY_BLOCK):
            block = ids[i : i + QUERY_BLOCK]
            gaps, found = tree.search(block, vectors[i : i + QUERY_BLOCK], k, factor)
            there = np.isfinite(gaps)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(block, k)[there.ravel()]), pa.array(found[there]), pa.array(gaps[there])],
                names=["query_id", "vec_id", "score"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, vectors, tree = None, [], [], None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            asked = batch.column("asked").to_numpy()
            key = shards * 2 + asked
            cuts = np.append(np.flatnonzero(np.diff(key, prepend=key[:1] - 1)), len(key))
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                own_ids = batch.column("vec_id").slice(low, high - low).to_numpy()
                own = _matrix(batch.column("vector").slice(low, high - low))
                if shards[low] != shard:
                    shard, ids, vectors, tree = shards[low], [], [], None
                if asked[low] == 0:
                    ids.append(own_ids)
                    vectors.append(own)
                    continue
                if tree is None and ids:
                    tree, ids, vectors = VantageTree(np.concatenate(ids), np.concatenate(vectors), k + 1), [], []
                if tree is not None:
                    yield from answer(tree, own_ids, own)

    return run


def nearest_rows(
    df: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    least_shards: int = LEAST_SHARDS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: each query's ``k`` nearest found rows.

    ``df`` has ``vec_id`` and ``embedding``; ``is_query`` (over ``vec_id``) names the queries,
    whose candidates are all rows but their own. The score is the Euclidean distance in double
    precision; equal ones go by smaller vec_id. Rows without id and vectors that are null, zero
    or hold null or non-finite components take no part. Of a repeated vec_id the smallest
    vector counts. Vectors are compared with those of their own length only. A query with
    fewer than ``k`` candidates gets them all; an empty table gives no rows.
    """
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = settle(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")))
    shards = max(least_shards, -(-rows.count() // shard_rows))
    # Shards of one vector length are numbered together, so lengths never mix.
    first = F.size("vector").cast("long") * shards
    data = rows.select((first + F.pmod(F.xxhash64("vec_id"), F.lit(shards))).alias("shard"), F.lit(0).alias("asked"), "*")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    queries = rows.filter(is_query).select("*", every.alias("n"))
    queries = queries.select((first + F.col("n")).alias("shard"), F.lit(1).alias("asked"), "vec_id", "vector")
    dealt = data.unionByName(queries).repartition(shards, "shard").sortWithinPartitions("shard", "asked")
    found = map_batches(dealt, _searcher(k, factor), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

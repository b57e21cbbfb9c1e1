"""Hard-negative mining with bounds carried along a spanning tree of the anchors.

Anchors are put into blocks, each with the minimum spanning tree of its vectors. The score
of a candidate c with an anchor lies within |edge| |c| of its score with the anchor's parent
in the tree, because <a, c> - <p, c> = <a - p, c>. Walking the tree from its root, whose
scores are computed outright, every anchor inherits an interval per candidate; only the
candidates whose interval overlaps what is asked are scored again, and their intervals
become points. Two such walks are made: one for the best rows of the anchor's own label, its
positives, and one for rows of other labels within the window that the positives' scores set.

Candidates are dealt to shards by a hash of their id and blocks of anchors are sent to
every shard. A task holds one shard and lets the blocks stream past; children with small
subtrees are walked first, so that only some log2(block) intervals are kept at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areakit.llm.common import map_batches
from areakit.operators.ordering import with_row_index
from areakit.session import settle

POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # percent of the positive's score
SCALE = 256
BLOCK_ANCHORS = 512
SHARD_ROWS = 65_536
LEAST_SHARDS = 12
FIRST_LOOK = 64  # candidates scored before the bound of the best ones is known

# Scores beyond are cut to it, so that percentages of them fit 64 bits.
MOST_SCORE = 1 << 56
# Products and sums below are exact in double precision.
_EXACT = float(1 << 53)


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(``scale`` x) of every component, as 64-bit integers (cut to their range)."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def finite(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(whole, F.lit(False))


@dataclass
class Block:
    """Anchors in the order of the walk, and the tree over them."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray  # place of the parent, -1 for the root
    edge: np.ndarray  # distance to the parent
    low: np.ndarray  # least and largest scores of the windows, a column for each positive
    high: np.ndarray


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The walk's order, and by place in it the parent's place and the distance to it."""
    n = len(vectors)
    real = vectors.astype(np.float64)
    parent, gap = np.zeros(n, np.int64), np.full(n, np.inf)
    inside = np.zeros(n, bool)
    joined = []
    at = 0
    parent[0] = -1
    for _ in range(n):
        inside[at] = True
        joined.append(at)
        apart = np.sqrt(((real - real[at]) ** 2).sum(axis=1))
        nearer = ~inside & (apart < gap)
        gap[nearer], parent[nearer] = apart[nearer], at
        at = int(np.where(inside, np.inf, gap).argmin())
    below = np.ones(n, np.int64)
    children: list[list[int]] = [[] for _ in range(n)]
    for node in reversed(joined[1:]):
        below[parent[node]] += below[node]
        children[parent[node]].append(node)
    order, stack = [], [0]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(sorted(children[node], key=lambda c: -below[c]))  # the smallest subtree comes first
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    up = np.array([-1 if parent[i] < 0 else place[parent[i]] for i in order], np.int64)
    edge = np.array([0.0 if parent[i] < 0 else gap[i] for i in order])
    return np.array(order), up, edge


class Shard:
    """The candidates of one shard."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.real = vectors.astype(np.float64)
        self.norms = np.sqrt((self.real**2).sum(axis=1))
        self.largest = float(np.abs(self.real).max(initial=0))

    def scores(self, anchor: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        """Exact inner products with the rows, as integers in double precision where those are exact."""
        size = float(np.abs(anchor.astype(np.float64)).max(initial=0))
        if size * self.largest * max(1, len(anchor)) < _EXACT:
            return self.real[rows] @ anchor.astype(np.float64)
        wide = [sum(int(x) * int(y) for x, y in zip(row, anchor)) for row in self.vectors[rows].tolist()]
        return np.array([max(-MOST_SCORE, min(MOST_SCORE, s)) for s in wide], np.int64)

    def exact(self, block: Block) -> bool:
        size = float(np.abs(block.vectors.astype(np.float64)).max(initial=0))
        return size * self.largest * max(1, block.vectors.shape[1]) < _EXACT

    def walk(self, block: Block, ask) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor its place and the rows and scores that ``ask`` picks.

        ``ask(place, low, high, score)`` gets the candidates' intervals and a function that
        scores rows and narrows their intervals.
        """
        if not self.exact(block):  # no bounds without exact arithmetic: score everything
            for at in range(len(block.ids)):
                every = self.scores(block.vectors[at], slice(None))
                yield at, *ask(at, every, every, lambda rows, every=every: every[rows])
            return
        last = np.zeros(len(block.ids), np.int64)
        for at, up in enumerate(block.parent.tolist()):
            if up >= 0:
                last[up] = at
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for at in range(len(block.ids)):
            up, anchor = int(block.parent[at]), block.vectors[at]
            if up < 0:
                low = self.scores(anchor, slice(None))
                high = low.copy()
            else:
                # One more than the product, for rounding.
                apart = float(block.edge[at]) * self.norms * (1 + 1e-9) + 1
                low, high = held[up][0] - apart, held[up][1] + apart
                if last[up] == at:
                    del held[up]

            def score(rows: np.ndarray, anchor=anchor, low=low, high=high) -> np.ndarray:
                found = self.scores(anchor, rows)
                low[rows], high[rows] = found, found
                return found

            yield at, *ask(at, low, high, score)
            if last[at] > at:
                held[at] = (low, high)

    def positives(self, block: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The ``k`` best other rows of each anchor's label: greater score, then smaller id."""

        def ask(at: int, low, high, score):
            rows = np.flatnonzero((self.labels == block.labels[at]) & (self.ids != block.ids[at]))
            if len(rows) > FIRST_LOOK:
                first = rows[np.argpartition(-low[rows], FIRST_LOOK - 1)[:FIRST_LOOK]]
                bound = np.partition(score(first), -k)[-k] if k <= FIRST_LOOK else -np.inf
                rows = rows[high[rows] >= bound]
            found = score(rows)
            best = np.lexsort((self.ids[rows], -found))[:k]
            return rows[best], found[best]

        return self.walk(block, ask)

    def negatives(self, block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Rows of other labels that fall into one of the anchor's windows at least."""

        def ask(at: int, low, high, score):
            none = np.zeros(0, np.int64), np.zeros(0)
            windows = block.low[at] <= block.high[at]
            if not windows.any():
                return none
            least, most = block.low[at][windows].min(), block.high[at][windows].max()
            rows = np.flatnonzero((self.labels != block.labels[at]) & (high >= least) & (low <= most))
            found = score(rows)
            inside = (found >= least) & (found <= most)
            return rows[inside], found[inside]

        return self.walk(block, ask)


_BLOCK = "ids array<long>, labels array<long>, vectors array<long>, parent array<long>, edge array<double>, low array<long>, high array<long>"


def _blocks(positives: int, window: tuple[int, int]):
    """One row per block of anchors, which come in order of their blocks."""
    least, most = window

    def made(rows: list[tuple]) -> pa.RecordBatch:
        vectors = np.array([r[3] for r in rows], np.int64).reshape(len(rows), len(rows[0][3]))
        order, parent, edge = spanning_tree(vectors)
        rows = [rows[i] for i in order.tolist()]
        # A window for each positive's score; one that is missing is empty.
        scores = [(r[4] or []) + [None] * (positives - len(r[4] or [])) for r in rows]
        low = [1 if s is None else -(-s * least // 100) for own in scores for s in own]
        high = [0 if s is None else s * most // 100 for own in scores for s in own]
        ids, labels = [r[1] for r in rows], [r[2] for r in rows]
        columns = [[x] for x in (ids, labels, vectors[order].ravel(), parent, edge, low, high)]
        kinds = [pa.list_(pa.float64() if i == 4 else pa.int64()) for i in range(7)]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[0][0]], pa.int64()), pa.array([vectors.shape[1]], pa.int32())]
            + [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            names=["block", "width", "ids", "labels", "vectors", "parent", "edge", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "vec_id", "label", "vector", "scores"))):
                if held and (row[0] != held[0][0] or len(row[3]) != len(held[0][3])):
                    yield made(held)
                    held = []
                held.append(row)
        if held:
            yield made(held)

    return run


def _anchor_blocks(anchors: DataFrame, positives: int, window: tuple[int, int]) -> DataFrame:
    """``anchors`` by block, with their spanning trees and the windows of their positives' ``scores``."""
    sorted_ = anchors.repartition("block").sortWithinPartitions("block", F.size("vector"), "vec_id")
    rows = sorted_.select("block", "vec_id", "label", "vector", "scores")
    return map_batches(rows, _blocks(positives, window), f"block long, width int, {_BLOCK}")


def _walk_shards(positives: int | None, negatives: int):
    """Rows come by shard, its candidates before the blocks of anchors."""

    def of(row: dict) -> Block:
        n = len(row["ids"])
        wide = lambda name: np.array(row[name], np.int64).reshape(n, len(row[name]) // n)
        ids, labels, parent = (np.array(row[c], np.int64) for c in ("ids", "labels", "parent"))
        return Block(ids, labels, wide("vectors"), parent, np.array(row["edge"]), wide("low"), wide("high"))

    def answer(shard: Shard, block: Block) -> pa.RecordBatch:
        anchor, window, other, score = [], [], [], []

        def add(at: int, place: int, rows: np.ndarray, found: np.ndarray) -> None:
            anchor.append(np.full(len(rows), block.ids[at]))
            window.append(np.full(len(rows), place))
            other.append(shard.ids[rows])
            score.append(found.astype(np.int64))

        if positives is not None:
            for at, rows, found in shard.positives(block, positives):
                add(at, 0, rows, found)
        else:
            for at, rows, found in shard.negatives(block):
                order = np.lexsort((shard.ids[rows], -found))
                rows, found = rows[order], found[order]
                for place, (least, most) in enumerate(zip(block.low[at].tolist(), block.high[at].tolist())):
                    inside = np.flatnonzero((found >= least) & (found <= most))[:negatives]
                    add(at, place, rows[inside], found[inside])
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (anchor, window, other, score)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["anchor_id", "place", "vec_id", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, shard = None, [], None
        for batch in batches:
            shards, asked = batch.column("shard").to_numpy(), batch.column("asked").to_numpy()
            key = shards * 2 + asked
            cuts = np.append(np.flatnonzero(np.diff(key, prepend=key[:1] - 1)), len(key)).tolist()
            for low, high in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(low, high - low)
                if shards[low] != current:
                    current, held, shard = shards[low], [], None
                if not asked[low]:
                    flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                    vectors = flat.reshape(len(part), len(flat) // len(part))
                    held.append((part.column("vec_id").to_numpy(), part.column("label").to_numpy(), vectors))
                    continue
                if shard is None and held:
                    shard, held = Shard(*(np.concatenate(x) for x in zip(*held))), []
                if shard is not None:
                    for row in part.select(["ids", "labels", "vectors", "parent", "edge", "low", "high"]).to_pylist():
                        yield answer(shard, of(row))

    return run


def _met(rows: DataFrame, blocks: DataFrame, shards: int, positives: int | None, negatives: int) -> DataFrame:
    """All blocks of anchors walked over all shards of candidates of the same vector length."""
    first = lambda width: width.cast("long") * shards
    data = rows.select(
        (first(F.size("vector")) + F.pmod(F.xxhash64("vec_id"), F.lit(shards))).alias("shard"), F.lit(0).alias("asked"), "*"
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = blocks.select("*", every.alias("n"))
    asked = asked.select((first(F.col("width")) + F.col("n")).alias("shard"), F.lit(1).alias("asked"), *blocks.columns[2:])
    dealt = data.unionByName(asked, allowMissingColumns=True)
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "asked")
    return map_batches(dealt, _walk_shards(positives, negatives), "anchor_id long, place int, vec_id long, score long")


def _best(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= most)


def mine_negatives(
    df: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    least_shards: int = LEAST_SHARDS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id`` and both scores.

    ``df`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` (over ``vec_id``) names the
    anchors. Components count as floor(``scale`` x); a score is the integer inner product with
    the anchor, greater scores come first and equal ones by smaller vec_id. An anchor's
    positives are its first ``positives`` other rows of its label. For each of them the first
    ``negatives`` rows of other labels with a score from ``window[0]`` to ``window[1]`` percent of
    the positive's are returned; a positive without any gives no row, as does a negative
    positive score.

    Rows without id or label and vectors that are null or hold null or non-finite
    components take no part. Of a repeated vec_id the smallest label, then vector, counts. Vectors
    meet those of their own length only. Scores beyond 2^56 count as that. An empty table
    gives no rows.
    """
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding")))
    rows = rows.select("vec_id", F.struct("label", quantized(F.col("embedding"), scale).alias("vector")).alias("row"))
    rows = settle(rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*"))
    shards = max(least_shards, -(-rows.count() // shard_rows))

    # Neighbours in this order share a label, so that a block's tree has short edges.
    numbered = with_row_index(rows.filter(is_anchor), [F.size("vector"), "label", "vec_id"])
    block = F.floor(F.col("row_index") / BLOCK_ANCHORS)
    anchors = settle(numbered.select("vec_id", "label", "vector", block.cast("long").alias("block")))

    none = F.lit(None).cast("array<long>")
    blocks = _anchor_blocks(anchors.withColumn("scores", none), positives, window)
    own = _best(_met(rows, blocks, shards, positives, negatives), ["anchor_id"], positives)
    own = settle(own.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    by_place = F.array_sort(F.collect_list(F.struct("place", "positive_score")))
    scores = own.groupBy(F.col("anchor_id").alias("vec_id")).agg(by_place["positive_score"].alias("scores"))
    windows = _anchor_blocks(anchors.join(scores, "vec_id"), positives, window)
    found = _best(_met(rows, windows, shards, None, negatives), ["anchor_id", "place"], negatives)
    found = found.withColumn("place", F.col("place") + 1).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    return found.join(own, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )

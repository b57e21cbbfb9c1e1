"""Hard negatives against scoring all rows for all anchors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from areakit.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, shard int, asked string, score string, block long"


def made(spark, rows):
    """Rows with columns that clash with names the operator uses inside."""
    return spark.createDataFrame([(*r, 7, "a", "b", 8) for r in rows], SCHEMA)


def brute(rows, every=5, positives=5, count=3, window=(50, 95)):
    kept = {}
    for doc, label, vector in rows:
        if doc is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        whole = [max(-(2**63), min(2**63 - 1, x)) for x in whole]
        kept[doc] = min(kept.get(doc, (label, whole)), (label, whole))
    out = []
    for anchor, (label, vector) in kept.items():
        if anchor % every:
            continue
        scored = []
        for other, (own, values) in kept.items():
            if other != anchor and len(values) == len(vector):
                score = sum(x * y for x, y in zip(vector, values))
                scored.append((-max(-negatives.MOST_SCORE, min(negatives.MOST_SCORE, score)), other, own))
        scored.sort()
        for less, positive, _ in [s for s in scored if s[2] == label][:positives]:
            top = -less
            found = [s for s in scored if s[2] != label and window[0] * top <= -100 * s[0] <= window[1] * top]
            out += [(anchor, positive, i + 1, s[1], top, -s[0]) for i, s in enumerate(found[:count])]
    return sorted(out)


def mined(df, every=5, **options):
    rows = negatives.mine_negatives(df, F.col("vec_id") % every == 0, **options)
    return sorted(map(tuple, rows.collect()))


def clustered(seed, n, width, labels=4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(labels, width))
    rows = []
    for i in range(n):
        label = int(draw.integers(labels))
        vector = centres[int(draw.integers(labels))] + 0.6 * draw.normal(size=width)
        rows.append((i, label, (vector / np.linalg.norm(vector)).tolist()))
    return rows


@pytest.mark.parametrize("seed, width", [(1, 3), (2, 24)])
def test_equals_all_scores(spark, seed, width):
    rows = clustered(seed, 400, width)
    expected = brute(rows)
    assert mined(made(spark, rows)) == expected and len(expected) > 100


def test_many_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 7)
    rows = clustered(3, 300, 8)
    assert mined(made(spark, rows), every=2, shard_rows=40, positives=3, negatives=2, window=(20, 80)) == brute(rows, 2, 3, 2, (20, 80))


def test_a_common_vector(spark):
    """A third of all rows are one vector: ties go by id, and nothing is lost."""
    rows = clustered(4, 300, 6)
    rows = [(i, i % 3, rows[0][2]) if i % 3 == 0 or i % 10 == 1 else (i, label, v) for i, label, v in rows]
    assert mined(made(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(5, 60, 3) + [
        (100, None, [0.1, 0.2, 0.3]),
        (105, 1, None),
        (None, 1, [0.1, 0.2, 0.3]),
        (110, 1, [0.1, None, 0.3]),
        (115, 1, [nan, 0.2, 0.3]),
        (120, 1, [inf, 0.2, 0.3]),
        (125, 1, [0.0, 0.0, 0.0]),
        (130, 1, []),
        (131, 2, []),
        (135, 1, [0.5, 0.5]),
        (136, 1, [0.5, 0.25]),
        (137, 2, [0.25, 0.25]),
        (5, 0, [0.9, 0.1, 0.1]),
        (10, 3, [0.2, 0.2, 0.2]),
        (10, 3, [0.2, 0.2, 0.2]),
        (140, 1, [3e38, 1.0, 1.0]),
        (145, 1, [2e9, 2e9, 1.0]),
        (146, 2, [1e9, 2e9, 1.0]),
    ]
    assert mined(made(spark, rows)) == brute(rows)
    assert mined(made(spark, [])) == []
    assert mined(made(spark, rows[:1])) == []


def test_bounds_hold_along_the_tree():
    """No interval of the walk excludes a true score, and the tree is spanning and shortest."""
    draw = np.random.default_rng(6)
    vectors = draw.integers(-200, 200, (40, 5))
    order, parent, edge = negatives.spanning_tree(vectors)
    assert sorted(order.tolist()) == list(range(40)) and parent[0] == -1
    assert all(0 <= parent[i] < i for i in range(1, 40))
    apart = np.sqrt(((vectors[:, None].astype(float) - vectors) ** 2).sum(axis=2))
    assert np.allclose(edge[1:], [apart[order[i], order[parent[i]]] for i in range(1, 40)])
    inside, total = {0}, 0.0
    while len(inside) < 40:  # Kruskal by hand: the shortest edge that leaves the tree
        gap, new = min((apart[i, j], j) for i in inside for j in range(40) if j not in inside)
        inside.add(new)
        total += gap
    assert np.isclose(edge.sum(), total)
    rows = draw.integers(-200, 200, (90, 5))
    shard = negatives.Shard(np.arange(90), np.zeros(90, np.int64), rows)
    none = np.zeros((40, 1), np.int64)
    block = negatives.Block(np.arange(40), np.zeros(40, np.int64), vectors[order], parent, edge, none, none)
    picked = []

    def ask(at, low, high, score):
        true = rows @ block.vectors[at]
        assert (low <= true).all() and (true <= high).all()
        some = draw.integers(0, 90, 9)
        picked.append((score(some) == true[some]).all())
        return some, true[some]

    assert len(list(shard.walk(block, ask))) == 40 and all(picked)


def test_few_candidates_are_scored_again(monkeypatch):
    """On clustered data the bounds leave most scores uncomputed."""
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(12, 16)) * 400
    rows = np.round(centres[np.arange(6_000) % 12] + draw.normal(size=(6_000, 16)) * 6).astype(np.int64)
    anchors = rows[:240]
    order, parent, edge = negatives.spanning_tree(anchors)
    none = np.zeros((240, 1), np.int64)
    labels = np.arange(6_000) % 12
    block = negatives.Block(order, labels[order], anchors[order], parent, edge, none, none)
    shard, scored = negatives.Shard(np.arange(6_000), labels, rows), []
    plain = shard.scores
    monkeypatch.setattr(shard, "scores", lambda a, r: (lambda x: (scored.append(len(x)), x)[1])(plain(a, r)))
    assert len(list(shard.positives(block, 5))) == 240
    assert sum(scored) < 0.35 * 240 * 6_000

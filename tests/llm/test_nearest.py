"""Vantage-point search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from areakit.llm import nearest


def clustered(n, dims, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (12, dims))
    rows = centres[draw.integers(0, 12, n)] + draw.normal(0, 0.35, (n, dims))
    return rows.astype(np.float32).astype(np.float64)


def brute(ids, rows, query, k):
    gaps = np.sqrt(((rows - rows[query]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, gaps)) if ids[i] != ids[query]]
    return [(ids[i], gaps[i]) for i in order[:k]]


@pytest.mark.parametrize("dims", [3, 24])
def test_factor_one_is_exact_and_larger_ones_near(dims):
    rows = clustered(2_000, dims, dims)
    rows[100:400] = rows[100]  # a large group of equal vectors
    ids = np.random.default_rng(9).permutation(5_000)[:2_000].astype(np.int64)
    tree = nearest.VantageTree(ids, rows, 11)
    queries = np.arange(0, 2_000, 20)
    for factor, least in ((1.0, 1.0), (nearest.FACTOR, 0.9)):
        gaps, found = tree.search(ids[queries], rows[queries], 10, factor)
        hits = 0
        for n, query in enumerate(queries):
            expected = brute(ids, rows, query, 10)
            hits += len({i for i, _ in expected} & set(found[n].tolist()))
            if factor == 1.0:
                assert found[n].tolist() == [i for i, _ in expected]
                assert np.allclose(gaps[n], [g for _, g in expected], rtol=1e-12)
        assert hits >= least * 10 * len(queries)


def test_nearest_rows(spark):
    rows = clustered(400, 5, 4)
    table = [(i, rows[i].tolist(), 3, "x") for i in range(400)]
    odd = [(400, None), (500, [0.0] * 5), (600, [1.0, None, 1.0, 1.0, 1.0]), (700, [math.nan] * 5), (None, [1.0] * 5)]
    odd += [(800, [math.inf] + [1.0] * 4), (900, [1.0, 2.0]), (901, [1.0, 3.0]), (1, rows[1].tolist())]
    table += [(i, v, 3, "x") for i, v in odd]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, rank int, score string")
    found = nearest.nearest_rows(df, F.col("vec_id") % 100 == 0, factor=1.0, shard_rows=60, least_shards=2).collect()
    ids = np.arange(400)
    expected = [
        (q, r + 1, int(i), float(g)) for q in range(0, 400, 100) for r, (i, g) in enumerate(brute(ids, rows, q, 10))
    ]
    expected.append((900, 1, 901, 1.0))  # vectors of another length, all candidates there are
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], rtol=1e-12)
    assert nearest.nearest_rows(df.limit(0), F.lit(True)).count() == 0

"""Connected components of an undirected graph given as a frame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areakit.session import settle


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (its component's smallest node) for every node of an edge.

    ``edges`` has long columns ``a`` and ``b``. Alternates two contractions until nothing
    changes: every node's larger neighbours are tied to its smallest one (large star), then
    its smaller neighbours are (small star). Rows never outnumber the edges, minima are
    combined before the shuffle, and every round is written to the shared folder, in as few
    files as the round before leaves rows for.
    """
    edges = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    most, state = edges.count(), None
    while True:
        ways = _both_ways(edges)
        least = ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = ways.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        smallest = down.groupBy("a").agg(F.min("b").alias("m"))
        tied = down.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = settle(tied.union(smallest.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), rows=most)
        found = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (found["n"], found["h"]) == state:
            break
        most, state = found["n"], (found["n"], found["h"])
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)

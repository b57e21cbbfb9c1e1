"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts form a group that stays together. Groups above a small share
of all bytes are items of their own; all others are dealt by hash to as many bundles as
there may be such items, and each bundle is an item. So at any size there are at most
``2 * shards * ITEMS_PER_SHARD`` items, plain sums that fit the driver. It differences
them: the two partial partitions with the largest spread are combined, largest subset with
smallest, until one is left. With hundreds of items a shard, sums end up bytes apart.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areakit.llm.common import only, running_offsets
from areakit.session import settle

SHARDS = 24
ROW_BYTES = 8  # what a document takes beside its text
ITEMS_PER_SHARD = 256
SLOT_ROWS = 50_000


def difference(sums: np.ndarray) -> np.ndarray:
    """Karmarkar-Karp over partial partitions, each a row of subset sums.

    Returns, for every row and column of ``sums``, the final subset it belongs to. Equal
    spreads are taken in the order of their appearance.
    """
    n, k = sums.shape
    order = np.argsort(-sums, axis=1, kind="stable")
    nodes = [row for row in np.take_along_axis(sums, order, axis=1)]
    heap = [(int(row[-1] - row[0]), i) for i, row in enumerate(nodes)]  # smallest: largest spread
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = nodes[a] + nodes[b][::-1]
        by_size = np.argsort(-total, kind="stable")
        merged = total[by_size]
        nodes[a] = nodes[b] = None
        heapq.heappush(heap, (int(merged[-1] - merged[0]), len(nodes)))
        nodes.append(merged)
        merges.append((a, b, by_size))
    # From the last merge back: where each sorted subset of a node ends up.
    final: list[np.ndarray | None] = [None] * len(nodes)
    if n:
        final[-1] = np.arange(k)
    for step in range(len(merges) - 1, -1, -1):
        a, b, by_size = merges[step]
        ends, final[n + step] = final[n + step], None
        placed = np.empty(k, np.int64)
        placed[by_size] = ends
        final[a], final[b] = placed, placed[::-1]
    out = np.empty((n, k), np.int64)
    for i in range(n):
        out[i, order[i]] = final[i]
    return out


def group_shards(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``group`` and ``shard`` for rows of distinct ``group`` (long) with their ``bytes``."""
    spark, items = groups.sparkSession, shards * ITEMS_PER_SHARD
    groups = settle(groups)
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("total")).first()["total"]
    alone = F.col("bytes") > total // items  # at most ``items`` groups
    bundle = F.pmod(F.xxhash64("group"), F.lit(items))
    named = groups.withColumns({"alone": alone, "item": F.when(alone, F.col("group")).otherwise(bundle)})
    sums = named.groupBy("alone", "item").agg(F.sum("bytes").alias("bytes")).collect()
    sums.sort(key=lambda r: (-r["bytes"], r["alone"], r["item"]))
    table = np.zeros((len(sums), shards), np.int64)
    table[:, 0] = [r["bytes"] for r in sums]
    final = difference(table)[:, 0].tolist()
    rows = [(r["alone"], r["item"], shard) for r, shard in zip(sums, final)]
    mapping = spark.createDataFrame(rows, "alone boolean, item long, shard int")
    return named.join(F.broadcast(mapping), ["alone", "item"]).select("group", "shard")


def shard_documents(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot`` and ``grown_shard`` (null).

    One row per row of ``df``. ``size`` is the text's UTF-8 bytes (null: none) plus 8; the
    bytes of the shards are near equal, rows of equal text share a shard (null counts as empty),
    and a shard's slots run from 0 without gaps. A null text has the crc32 of no bytes. Null
    and repeated doc_ids are kept; repeated rows get slots of their own, in either order.
    One group larger than a shard's share cannot be balanced and fills most of a shard.
    """
    text = F.coalesce("text", F.lit(""))
    base = settle(
        only(df, doc_id="long", text="string").select(
            "doc_id",
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("group"),
        )
    )
    groups = base.groupBy("group").agg(F.sum("size").alias("bytes"))
    sharded = base.join(group_shards(groups, shards), "group")
    buckets = max(1, -(-base.count() // (shards * SLOT_ROWS)))
    bucket = F.pmod(F.xxhash64("doc_id", "group"), F.lit(buckets)).cast("int")
    placed = settle(sharded.select("doc_id", "size", "text_crc32", "shard", bucket.alias("bucket")))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    offsets = running_offsets(counts, ["shard"], "bucket", "rows", "offset")
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (
        placed.withColumn("within", within)
        .join(offsets, ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(df: DataFrame, sharded: DataFrame, path: str) -> None:
    """Write ``df`` (distinct doc_ids) as one folder per shard, each file in slot order."""
    df.join(sharded.select("doc_id", "shard", "slot"), "doc_id").repartition("shard").sortWithinPartitions(
        "shard", "slot"
    ).write.partitionBy("shard").parquet(path)

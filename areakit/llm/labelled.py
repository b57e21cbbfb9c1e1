"""Bounded samples of labelled documents, and what both classifiers return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areakit.llm.common import only


def held_out(modulus: int, remainder: int) -> Column:
    """Rows no label may be learned from, by the crc32 of the doc_id as text (null: none)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held: Column, limit: int) -> DataFrame:
    """``label`` (0 or 1) and ``text`` of at most ``limit`` labelled documents, in hash order.

    Held-out rows, null ids and labels other than 0 and 1 are left out. Of a repeated
    doc_id the larger label and the smaller text count. The ids fit a broadcast: they are
    at most ``limit``.
    """
    chosen = (
        only(labels, doc_id="long", **{label: "int"})
        .filter(F.col(label).isin(0, 1) & ~held & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    texts = only(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id")
    return (
        texts.groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
        .select("label", "text")
    )


def predicted(scored: DataFrame, held: Column, threshold: float) -> DataFrame:
    return scored.withColumns({"held_out": held, "predicted": (F.col("score") >= threshold).cast("int")})

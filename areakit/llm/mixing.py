"""Mixing sources to target weights, in DataFrame operations only.

Each document gets a hash-random key. Within a source, documents stand in the order of
their keys; prefix sums of their sizes come from sums over equal ranges of the key space
(buckets of about ``BUCKET_ROWS`` rows, so a source with a third of all rows is as evenly
spread as any other) plus a running sum inside each bucket. A source whose target exceeds
its size is repeated in whole epochs; the rest is cut at exactly its budget, so the
document at the cut gives only its first words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areakit.llm.common import hash_bucket, only, running_offsets, word_count, word_list
from areakit.session import settle

BUCKET_ROWS = 5_000
REPEATS = 10_000


def row_key() -> Column:
    """A digest of id, source and text as the random key of a row; null counts as empty."""
    parts = [F.col("doc_id").cast("string"), F.col("source"), F.md5(F.col("text"))]
    return F.md5(F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts)))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_epochs: int) -> DataFrame:
    """``source``, ``place``, ``n_rows``, ``source_size``, ``target`` and ``budget`` of each source.

    Sources stand by code point, null last, and weigh ``weights`` in turn. Together they
    share the size of all sources; a target stops at ``max_epochs`` times its source, and
    what is over is shared again by weight. With c = cap / weight ascending, the stopped
    sources come first, and the level that all others reach is the largest of
    (total - caps before) / (total weight - weights before). Only this table of one row
    per source passes through a single window.
    """
    by_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*map(F.lit, weights))
    weighed = by_source.withColumn("place", place).select(
        "*",
        F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")).cast("double").alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
    )
    ascending = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    whole = ascending.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = weighed.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return levelled.select(
        "source", "place", "n_rows", "source_size", target.alias("target"), F.round(target).cast("long").alias("budget")
    )


def mix_sources(df: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: int = 3) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``key``, ``epochs``, ``cut``, ``taken``.

    One row per row of ``df``. ``size`` counts words (null and blank texts: 0). A document
    is taken ``epochs`` times whole and once more for its first ``cut`` words, together
    ``taken`` words; the sum over a source is its rounded target. Rows are ordered by a
    digest of id, source and text, so reruns agree; only repeated rows tie, and are alike.
    Null ids and null sources take part (null is one source). Other columns are ignored.
    """
    source = only(df, doc_id="long", source="string", text="string")
    sizes = settle(source.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_key().alias("key")))
    targets = settle(source_targets(sizes, weights, max_epochs))
    sourced = targets.withColumnRenamed("source", "of")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n_rows") / BUCKET_ROWS))
    keyed = sizes.join(sourced, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    keyed = keyed.withColumn("bucket", hash_bucket(F.col("key"), buckets))
    totals = keyed.groupBy("place", "bucket").agg(F.sum("size").alias("size"))
    offsets = running_offsets(totals, ["place"], "bucket", "size", "offset")
    inside = Window.partitionBy("place", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    ordered = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    epochs = F.when(F.col("size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    left = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("inside")
    # A whole extra copy counts as an epoch, what is less as a cut.
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left")))
    extra = (F.col("part") == F.col("size")) & (F.col("size") > 0)
    return (
        ordered.join(offsets, ["place", "bucket"])
        .withColumn("epochs", epochs)
        .withColumn("left", left)
        .withColumn("part", part)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "key",
            (F.col("epochs") + extra.cast("long")).alias("epochs"),
            F.when(extra, F.lit(0)).otherwise(F.col("part")).alias("cut"),
            (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: int = 3) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``.

    The document at a source's cut comes with its first words only, joined by one blank,
    and ``n_chars`` (if it is a column) counts them. Rows alike in id, source and text are
    copies of one row, which comes as often as they are taken together. Documents without
    words are in no mix.
    """
    taken = (
        mix_sources(docs, weights, max_epochs)
        .filter((F.col("epochs") > 0) | (F.col("cut") > 0))
        .groupBy("key")
        .agg(F.sum("epochs").alias("__whole"), F.max("cut").alias("__cut"))
        .withColumnRenamed("key", "__key")
    )
    once = docs.withColumn("__key", row_key()).dropDuplicates(["__key"])
    # Whole copies by blocks, so that no array grows with the number of repeats.
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"__whole div {REPEATS}"))
    in_block = F.least(F.lit(REPEATS), F.col("__whole") - F.col("__block") * REPEATS).cast("int")
    last = (F.col("__block") == 0) & (F.col("__cut") > 0)
    uncut = F.array_repeat(F.lit(0).cast("long"), in_block)
    pieces = F.when(last, F.concat(uncut, F.array("__cut"))).otherwise(uncut)
    rows = once.join(taken, "__key").withColumn("__block", F.explode(blocks)).withColumn("__first", F.explode(pieces))
    cut = F.col("__first") > 0
    first_words = F.array_join(F.slice(word_list(F.col("text")), 1, F.greatest(F.lit(1), F.col("__first")).cast("int")), " ")
    rows = rows.withColumn("__text", F.when(cut, first_words).otherwise(F.col("text")))
    shown = {"text": F.col("__text").alias("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        shown["n_chars"] = F.when(cut, F.length("__text")).otherwise(F.col("n_chars")).cast(kind).alias("n_chars")
    return rows.select(*(shown.get(c, F.col(c)) for c in docs.columns))

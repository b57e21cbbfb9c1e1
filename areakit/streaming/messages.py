"""Messages ``<ignored>,<neighborhood id>,<price>``: source, parsing, routing."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from areakit.functions.numbers import finite

CATEGORY = "Neighborhood_ID"
PRICE = "Price"

MEANWHILE_SECONDS = 5  # between two calls of what is done while a query runs


def message_stream(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """A stream of messages as one text column ``value``.

    ``fmt`` is ``kafka`` with its options on a cluster that has the connector, or
    ``text`` with a folder.
    """
    reader = spark.readStream.format(fmt).options(**options)
    source = reader.load(path) if path else reader.load()
    return source.select(F.col("value").cast("string").alias("value"))


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic, from its first one unless ``startingOffsets`` says otherwise."""
    named = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    return message_stream(spark, "kafka", **{**named, **options})


def field(value: Column, place: int) -> Column:
    """One comma-separated field; null where the message is too short."""
    return F.get(F.split(value, ","), F.lit(place))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Area id and price of each message, batch or streaming; ``value`` is kept.

    A blank area id is none, and a price that is not finite is no number.
    """
    area = field(F.col("value"), 1)
    return messages.select(
        "value",
        F.when(F.trim(area) != "", area).alias(CATEGORY),
        finite(field(F.col("value"), 2).try_cast("double")).alias(PRICE),
    )


def is_complete() -> Column:
    return F.col(CATEGORY).isNotNull() & F.col(PRICE).isNotNull()


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(is_complete()).select(CATEGORY, PRICE)


def rejected(parsed: DataFrame) -> DataFrame:
    """Messages without an id or a numeric price, with the reason."""
    return parsed.filter(~is_complete()).select("value", reject_reason().alias("reason"))


def reject_reason() -> Column:
    return (
        F.when(F.col(CATEGORY).isNull(), "no area")
        .when(F.coalesce(F.trim(field(F.col("value"), 2)), F.lit("")) == "", "no price")
        .when(F.col(PRICE).isNull(), "price is no number")
    )


def append_to(
    df: DataFrame,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    every: str | None = None,
    partition_by: str | None = None,
    name: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Start an append query that stops when it has caught up.

    With ``every`` or with ``once`` false it goes on taking what arrives, in batches that
    start every so often or as soon as the one before is done.

    ``checkpoint`` belongs to this query and source alone: restarting with it
    continues after the last committed batch.
    """
    writer = (
        df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if name:
        writer = writer.queryName(name)
    if every or once:
        writer = writer.trigger(**({"processingTime": every} if every else {"availableNow": True}))
    return writer.start(path) if path else writer.start()


def run_for(query: StreamingQuery, seconds: int | None = None, meanwhile: Callable[[], None] | None = None) -> None:
    """Wait for the query, at most ``seconds``, and stop it.

    ``meanwhile`` is called every few seconds until then.
    """
    try:
        if meanwhile is None:
            query.awaitTermination(*([] if seconds is None else [seconds]))
            return
        left = float("inf") if seconds is None else seconds
        end = time.monotonic() + left
        while left > 0 and not query.awaitTermination(max(0.001, min(MEANWHILE_SECONDS, left))):
            meanwhile()
            left = end - time.monotonic()
    finally:
        query.stop()


def routed(parsed: DataFrame) -> DataFrame:
    """All messages with their route, to be written partitioned by ``route``.

    One query then keeps accepted and rejected messages apart in the same
    transaction, and each message is read once.
    """
    return parsed.select(
        "value",
        CATEGORY,
        PRICE,
        reject_reason().alias("reason"),
        F.when(is_complete(), "accepted").otherwise("rejected").alias("route"),
    )

"""Micro-batches as units: sinks that a replay does not change, and the log of offsets."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch"

# For a query of many small batches. Nothing is forgotten of its offsets and commits, of which
# Spark keeps the last 100 batches; the logs of files are compacted less often than in every tenth
# batch, as that writes all their entries anew; files are packed into tasks of
# ``maxPartitionBytes``, however few tasks that are: a small batch is one task and one file.
MANY_BATCHES = {
    "spark.sql.streaming.minBatchesToRetain": str(2**31 - 1),
    "spark.sql.streaming.fileSource.log.compactInterval": "1000",
    "spark.sql.streaming.fileSink.log.compactInterval": "100",
    "spark.sql.files.minPartitionNum": "1",
}
# Hadoop's ``FileContext``, which Spark writes checkpoints with, starts several processes for each
# file of a local disk; its ``FileSystem`` renames a file as safely there (class of Spark 4.1).
LOCAL_LOGS = {
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
}
KEPT_COMPACTIONS = 2
_ENTRY = re.compile(r"(\d+)(\.compact)?")


def many_batches(spark: SparkSession, checkpoint: str) -> SparkSession:
    """A session with ``spark``'s settings for a query of many small batches, whose log stays whole.

    The source has to be read in it, at every start, and what a file sink has written, as Spark finds
    its way in the logs of files by the session's intervals. ``checkpoint`` is the folder of the
    query's log. As Spark then clears no log, :func:`trim_sink_log` should be called now and then.
    """
    session = spark.newSession()
    local = _file_system(spark, checkpoint).getScheme() == "file"
    for key, value in {**(LOCAL_LOGS if local else {}), **spark.conf.getAll, **MANY_BATCHES}.items():
        if session.conf.get(key, None) != value:
            session.conf.set(key, value)
    return session


def trim_sink_log(spark: SparkSession, path: str) -> None:
    """Remove what later compactions have taken in from the log of the file sink at ``path``.

    A sink lists its log in every batch. The last two compactions and all that follows stay: Spark
    reads nothing from before the last one, and tells by the two how often it compacts.
    """
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place, files = path_of(f"{path}/_spark_metadata"), _file_system(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
    entries = {name: int(found[1]) for name in names if (found := _ENTRY.fullmatch(name))}
    compactions = sorted(number for name, number in entries.items() if name.endswith(".compact"))
    if len(compactions) > KEPT_COMPACTIONS:
        for name, number in entries.items():
            if number < compactions[-KEPT_COMPACTIONS]:
                files.delete(path_of(place, name), False)


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def start_batches(
    df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], every: str | None = None, once: bool = True
) -> StreamingQuery:
    """Start a query that hands each micro-batch and its id to ``write``.

    After a failure the last batch may be handed over again, with the same id and the same
    rows, so ``write`` must leave the same state however often it is called. Stops when it has
    caught up unless ``every`` is given or ``once`` is false.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if every or once:
        writer = writer.trigger(**({"processingTime": every} if every else {"availableNow": True}))
    return writer.start()


def split_targets(targets: dict[str, str], route: str = "route", fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A writer that puts the rows of each route into its own target.

    A batch owns the folder ``batch=<id>`` of every target: writing it again replaces that
    folder and nothing else. The batch is computed once for all targets.
    """

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            for name, path in targets.items():
                rows = kept.filter(F.col(route) == name).drop(route)
                rows.write.format(fmt).mode("overwrite").save(f"{path}/{BATCH}={number}")
        finally:
            kept.unpersist()

    return write


def offset_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a query's checkpoint says it has read, one row per batch and source.

    ``batch``, ``source`` (from 0), ``start_offset`` and ``end_offset`` as the source writes them
    (JSON; the first start is null), and ``committed``: whether the batch has been finished. A
    batch planned but not committed is run again, over the same offsets, at the next start.
    Spark forgets all but the last 100 batches unless the query runs in :func:`many_batches`.
    """

    def entries(kind: str) -> DataFrame:
        files = spark.read.text(f"{checkpoint}/{kind}", wholetext=True)
        number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1).try_cast("long")
        return files.select(number.alias("batch"), F.split("value", "\n").alias("lines")).filter("batch IS NOT NULL")

    # Fixed layout of the log: a version line, a line of settings, and a line per source.
    offsets = entries("offsets").select("batch", F.posexplode(F.slice("lines", F.lit(3), F.size("lines"))).alias("source", "end_offset"))
    offsets = offsets.filter("end_offset <> ''")
    start = F.lag("end_offset").over(Window.partitionBy("source").orderBy("batch"))
    committed = entries("commits").select("batch", F.lit(True).alias("committed"))
    return offsets.withColumn("start_offset", start).join(committed, "batch", "left").select(
        "batch", "source", "start_offset", "end_offset", F.coalesce("committed", F.lit(False)).alias("committed")
    )


def forget_commit(spark: SparkSession, checkpoint: str, batch: int) -> None:
    """Take back a batch's commit, as if the process had ended between its write and the commit."""
    context = spark.sparkContext
    for name in (str(batch), f".{batch}.crc"):
        path = context._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{name}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, False)

"""The latest record of each key, kept up to date from files as they arrive.

The state is a table in ``BUCKETS`` folders by a hash of the key. A stream over the landing
folder remembers which files it has read; each of its batches is reduced to one record per
key, and only the buckets it touches are read, merged and replaced. The greater record wins,
whoever comes first, so a batch that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit.operators.latest import latest
from areakit.session import discard, settle
from areakit.streaming.batches import start_batches
from areakit.streaming.messages import run_for

BUCKETS = 64
BUCKET = "bucket"


def read_state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The kept records, without their bucket; none before the first batch."""
    return _state(spark, path, schema).drop(BUCKET)


def _state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = [*schema.fields, T.StructField(BUCKET, T.IntegerType())]
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], T.StructType(fields))
    return spark.read.schema(T.StructType(fields)).parquet(path)


def merge_latest(path: str, schema: T.StructType, keys: list[str], order: list[str], buckets: int) -> Callable[[DataFrame, int], None]:
    """A writer that merges a batch into the state at ``path``."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new = settle(latest(batch.select(*schema.names), keys, order).withColumn(BUCKET, bucket))
        touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())  # at most ``buckets``
        if touched:
            old = _state(spark, path, schema).filter(F.col(BUCKET).isin(touched))
            merged = settle(latest(old.unionByName(new), keys, order))
            replaced = merged.repartition(len(touched), BUCKET).write.mode("overwrite").partitionBy(BUCKET)
            replaced.option("partitionOverwriteMode", "dynamic").parquet(path)
            discard(merged)
        discard(new)

    return write


def keep_latest(
    arriving: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    order: list[str],
    buckets: int = BUCKETS,
    seconds: int | None = None,
) -> None:
    """Merge what has arrived into the state at ``path``, and stop.

    ``arriving`` is a stream of records; ``order`` names the columns by which the greatest record
    of each key is kept. The number of ``buckets`` belongs to the state and must not change.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in arriving.schema.fields])
    run_for(start_batches(arriving, checkpoint, merge_latest(path, schema, keys, order, buckets)), seconds)

"""What the operators share: word rules, column selection, Arrow batches, hash buckets."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import areakit

# A word is a run of characters that are not blank; blanks are these six.
BLANKS = " \t\n\v\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Rows and bytes that reach a Python task at a time.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 * 1024 * 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def word_list(text: Column) -> Column:
    """The words of a text as an array; empty for null or blank texts."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, BLANK_RUN))).otherwise(0).cast("long")


def only(df: DataFrame, **types: str) -> DataFrame:
    """Just these columns, cast; any other column of the caller's frame is left out."""
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in types.items()))


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies, whatever folder they start in."""
    root = str(Path(areakit.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches bounded in rows and bytes."""
    reach_workers(df.sparkSession)
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def hash_bucket(key: Column, buckets: Column) -> Column:
    """Which of ``buckets`` equal ranges the hexadecimal digest ``key`` falls into.

    The order of buckets is the order of keys.
    """
    head = F.conv(F.substring(key, 1, 12), 16, 10).cast("long")
    return F.floor(head.cast("double") / F.lit(float(16**12)) * buckets).cast("int")


def running_offsets(totals: DataFrame, group: list[str], place: str, value: str, name: str) -> DataFrame:
    """The sum of ``value`` over the places before each one of its group."""
    before = Window.partitionBy(*group).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*group, place, F.coalesce(F.sum(value).over(before), F.lit(0)).alias(name))

"""Dated listing snapshots."""

from __future__ import annotations

import functools

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit import schemas
from areakit.functions.paths import FILE_PATH, snapshot_date


def _dated(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.filter(F.col("neighborhood").isNotNull()).select(
        *(F.col(f.name).cast(f.dataType) for f in schema.fields),
        snapshot_date(F.col(FILE_PATH)).alias("date"),
    )


def _merged(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """The schema of all these files, from a job over their footers; none if types differ."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*files).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None


def _agree(one: T.StructType, other: T.StructType) -> bool:
    return all(one[n].dataType == other[n].dataType for n in one.names if n in other.names)


def schema_groups(spark: SparkSession, directory: str) -> list[tuple[list[str], T.StructType]]:
    """Parquet files below a folder in groups whose columns agree in type, with each one's schema.

    If all do, that is one group, named by the folder. Else the files, sorted by path and so by
    date, are halved until each part agrees: types change at few dates, so few footers are read
    more than a few times. A part whose first and last files differ is halved unseen.
    """
    everywhere = {"recursiveFileLookup": True, "pathGlobFilter": "*.parquet"}
    listed = spark.read.format("binaryFile").options(**everywhere).load(directory).select("path")
    every = sorted(r["path"] for r in listed.collect())
    if not every:
        return [([directory], T.StructType())]

    @functools.cache
    def schema_of(file: str) -> T.StructType:
        return spark.read.parquet(file).schema

    waiting, found = [every], []
    while waiting:
        files = waiting.pop()
        agree = len(files) == 1 or _agree(schema_of(files[0]), schema_of(files[-1]))
        schema = _merged(spark, files) if agree else None
        if schema is not None:
            found.append((files, schema))
        else:
            half = len(files) // 2
            waiting += [files[half:], files[:half]]
    return [([directory], found[0][1])] if len(found) == 1 else found


def conformed(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of one type as another: numbers and texts cast, null where that fails, structs by field."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = [
            (conformed(column[f.name], have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields)).cast(want)
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) or isinstance(want, (T.StructType, T.ArrayType, T.MapType)):
        return F.lit(None).cast(want)
    return column.try_cast(want)


def _conformed_files(spark: SparkSession, directory: str, schema: T.StructType) -> list[DataFrame]:
    """A frame for each set of types that files have for the wanted columns, with ``file``."""
    readers: dict[tuple, tuple[list[str], T.StructType]] = {}
    for files, found in schema_groups(spark, directory):
        have = T.StructType([f for f in found.fields if f.name in schema.names])
        key = tuple((f.name, f.dataType.simpleString()) for f in have.fields)
        readers.setdefault(key, ([], have))[0].extend(files)
    frames = []
    for files, have in readers.values():
        read = spark.read.schema(have).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(*files)
        columns = [
            (conformed(F.col(f.name), have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
        frames.append(read.select(*columns, F.col(FILE_PATH).alias("file")))
    return frames


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def read_snapshots(
    spark: SparkSession, directory: str, schema: T.StructType = schemas.LISTING
) -> DataFrame:
    """All Parquet snapshots under a folder, each row with its snapshot's date.

    Files may differ in columns and types: those of equal types are one scan, whose columns
    are brought to the declared types; a value that does not fit is null. A file without some
    column reads as null there, so one without ``neighborhood`` contributes no rows
    (:func:`gated_files` names it), and a folder without matching files gives an empty frame
    with the declared columns.
    """
    frames = _conformed_files(spark, directory, schema)
    return _union([f.filter(F.col("neighborhood").isNotNull()) for f in frames]).select(
        *schema.names, snapshot_date(F.col("file")).alias("date")
    )


def gated_files(spark: SparkSession, directory: str, column: str = "neighborhood") -> DataFrame:
    """Files with rows of which none has a value in ``column``: ``file``, ``date`` and ``n_rows``."""
    wanted = T.StructType([schemas.LISTING[column]])
    counted = _union(_conformed_files(spark, directory, wanted)).groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(column).alias("n_kept")
    )
    return counted.filter("n_kept = 0").select("file", snapshot_date(F.col("file")).alias("date"), "n_rows")


def read_listing_json(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = schemas.LISTING,
    multi_line: bool = False,
) -> DataFrame:
    """All JSON-array snapshots under a folder, one row per listing.

    Arrays on a single line, as delivered, need no ``multi_line``; with it, arrays
    may span lines but every file is one task's work.
    """
    return _dated(
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("multiLine", multi_line)
        .json(directory),
        schema,
    )


def arriving_snapshots(
    spark: SparkSession, directory: str, schema: T.StructType = schemas.LISTING, **options: object
) -> DataFrame:
    """Parquet snapshots of the declared types as a stream that reads each file once.

    ``options`` are the file stream's, as ``maxFilesPerTrigger``. The folder must exist.
    """
    reader = spark.readStream.schema(schema).options(recursiveFileLookup=True, pathGlobFilter="*.parquet", **options)
    return _dated(reader.parquet(directory), schema)


def read_dated(spark: SparkSession, path: str, schema: T.StructType = schemas.LISTING) -> DataFrame:
    """Listings that :func:`lay_out_by_date` wrote; filters and joins on ``date`` prune its folders."""
    dated = T.StructType([*[f for f in schema.fields if f.name != "date"], T.StructField("date", T.DateType())])
    return spark.read.schema(dated).parquet(path)


def lay_out_by_date(listings: DataFrame, path: str) -> None:
    """Rewrite snapshots as ``date=...`` folders, so date filters prune files.

    Rebalancing gives each date its own files and splits a date that is too large.
    """
    listings.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(path)

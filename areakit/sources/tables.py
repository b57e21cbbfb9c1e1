"""Tables of any batch format: scan and overwrite."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """A stored collection as a frame.

    ``fmt`` is any installed source, so a document store is read by its
    connector's name and options instead of a path.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def overwrite_table(
    df: DataFrame, path: str | None = None, fmt: str = "parquet", partition_by: list[str] | None = None, **options: str
) -> None:
    """Replace a stored collection by ``df``.

    With a ``path`` the new files are written beside the old ones first and then take their
    place by two renames, so a write that fails leaves the old collection as it was. Other
    collections are replaced as their connector does it.
    """
    if not path:
        df.write.format(fmt).mode("overwrite").options(**options).save()
        return
    path = path.rstrip("/")
    staged, old = (f"{path}.{kind}-{uuid.uuid4().hex}" for kind in ("staged", "old"))
    spark = df.sparkSession
    try:
        df.write.format(fmt).options(**options).save(staged, partitionBy=partition_by)
    except Exception:
        _delete(spark, staged)
        raise
    replaced = _rename(spark, path, old)
    if not _rename(spark, staged, path):
        if replaced:
            _rename(spark, old, path)
        raise OSError(f"{staged} could not take the place of {path}")
    if replaced:
        _delete(spark, old)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet", **options: str) -> None:
    """Replace only the partitions that ``df`` has rows for; all others stay."""
    writer = df.write.format(fmt).mode("overwrite").options(**{"partitionOverwriteMode": "dynamic", **options})
    writer.partitionBy(*partition_by).save(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _rename(spark: SparkSession, path: str, to: str) -> bool:
    """Whether there was something to rename and it has its new name."""
    files, source = _file_system(spark, path)
    return files.exists(source) and files.rename(source, _file_system(spark, to)[1])


def _delete(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)

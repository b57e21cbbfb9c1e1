"""Grouping rows into arrays, a fixed number of parts per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements that an array may hold: what a row and a task bear.
MOST_ELEMENTS = 100_000


def element_part(key: Column, parts: int) -> Column:
    """The part of 0 to ``parts`` - 1 that an element belongs to, by a hash of its key."""
    draw = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return (draw % parts).cast("int")


def check_parts(df: DataFrame, keys: list[str], element_key: str, parts: int, most: int = MOST_ELEMENTS) -> None:
    """Fail, naming the key, if one of its parts would hold more than ``most`` elements.

    One aggregation, so that too few parts show before arrays outgrow a row in some task.
    """
    sizes = df.groupBy(*keys, element_part(F.col(element_key), parts).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max_by(F.struct(*keys, "n"), "n").alias("of")).first()["of"]
    if largest is not None and largest["n"] > most:
        key = ", ".join(str(largest[k]) for k in keys)
        raise ValueError(f"a part of {key} has {largest['n']} elements, more than {most}: ask for more than {parts} parts")


def nest(
    df: DataFrame, keys: list[str], element: Column, name: str, element_key: str, parts: int
) -> DataFrame:
    """Sorted arrays of ``element``: one row per key and ``part`` that has any.

    The caller states ``parts`` so that no array of the largest key outgrows a row; the
    output key is (keys, part) at every size. Parts also spread a large key over tasks.
    """
    return (
        df.withColumn("part", element_part(F.col(element_key), parts))
        .groupBy(*keys, "part")
        .agg(F.array_sort(F.collect_list(element)).alias(name))
    )

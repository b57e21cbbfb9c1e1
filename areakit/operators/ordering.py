"""Numbering rows by a total order without bringing them together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areakit.session import pin

_POSITION_MASK = (1 << 33) - 1


def with_row_index(
    df: DataFrame, order: list[str | Column], name: str = "row_index", start: int = 0
) -> DataFrame:
    """Add each row's position in ``order`` (which must be a total order).

    A global ``row_number`` would sort the whole table in one task. Here rows are
    range-partitioned and sorted, checkpointed, counted per partition, and numbered by
    the rows in the partitions before plus the place in their own. Only the
    partition counts, one row each, go through a single window.
    """
    placed = pin(df.repartitionByRange(*order).sortWithinPartitions(*order))
    tagged = placed.select(
        "*",
        F.spark_partition_id().alias("_partition"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)).alias("_place"),
    )
    sizes = tagged.groupBy("_partition").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_partition")) - F.col("_rows")
    offsets = sizes.select("_partition", before.alias("_before"))
    return (
        tagged.join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_before") + F.col("_place") + start)
        .drop("_partition", "_place", "_before")
    )

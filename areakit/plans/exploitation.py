"""From the formatted tables to the indicator tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from areakit.operators.kpi import price_by_area_nested, rent_income_pairs
from areakit.sources.tables import overwrite_table, read_table


def indicators(nested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean price with listing count, and rent with income, per area."""
    return price_by_area_nested(nested), rent_income_pairs(nested)


def publish_indicators(
    spark: SparkSession, formatted_zone: str, exploitation_zone: str, fmt: str = "parquet"
) -> None:
    nested = read_table(spark, f"{formatted_zone}/nested_data", fmt)
    prices, pairs = indicators(nested)
    overwrite_table(prices, f"{exploitation_zone}/kpi1", fmt)
    overwrite_table(pairs, f"{exploitation_zone}/kpi2", fmt)

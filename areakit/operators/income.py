"""Yearly income indicators per area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areakit import schemas
from areakit.functions.numbers import finite
from areakit.operators.reconcile import reconcile


def nest_income(rows: DataFrame) -> DataFrame:
    """Yearly report rows (one per area and year) as one document per area.

    The array holds one element per year, so its length is bounded by the years
    reported; copies of a row collapse before the shuffle.
    """
    year = F.struct(
        F.col("Any").cast("int").alias("year"), F.col("RFD"), F.col("pop")
    )
    return rows.groupBy(
        F.col("Nom_Barri").alias(schemas.INCOME_NAME), F.col("Nom_Districte").alias("district_name")
    ).agg(F.array_sort(F.collect_set(year)).alias("info"))


def most_recent(info: Column, field: str) -> Column:
    """The ``field`` of the latest year; the first such element wins a tie.

    Null for an empty array.
    """

    def newest_first(a: Column, b: Column) -> Column:
        return F.when(a["year"] > b["year"], -1).when(a["year"] < b["year"], 1).otherwise(0)

    return F.get(F.array_sort(info, newest_first), F.lit(0))[field]


def with_most_recent(income: DataFrame) -> DataFrame:
    """Area, district, and the latest RFD and population as numbers.

    Values that are no numbers (``'-'``) become null.
    """
    return income.select(
        F.col(schemas.INCOME_NAME).alias("name"),
        "district_name",
        finite(most_recent(F.col("info"), "RFD").try_cast("double")).alias("rfd"),
        finite(most_recent(F.col("info"), "pop").try_cast("double")).alias("pop"),
    )


def unusable_income(income: DataFrame) -> DataFrame:
    """Areas left out of the profile because a latest value is no finite number, with both."""
    latest = with_most_recent(income)
    raw = income.select(
        F.col(schemas.INCOME_NAME).alias("name"),
        "district_name",
        most_recent(F.col("info"), "RFD").cast("string").alias("rfd_text"),
        most_recent(F.col("info"), "pop").cast("string").alias("pop_text"),
    )
    missing = latest.filter(F.col("rfd").isNull() | F.col("pop").isNull())
    same = raw["name"].eqNullSafe(missing["name"]) & raw["district_name"].eqNullSafe(missing["district_name"])
    return raw.join(missing, same, "left_semi").distinct()


def income_profile(income: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct latest indicators by reconciled name; areas without numbers left out."""
    usable = with_most_recent(income).filter(F.col("rfd").isNotNull() & F.col("pop").isNotNull())
    return (
        reconcile(usable, pairs, "name")
        .select("neighborhood", "neighborhood_id", "district_name", "rfd", "pop")
        .distinct()
    )

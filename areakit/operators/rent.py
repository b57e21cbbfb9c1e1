"""Rent prices per area and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit.functions.numbers import finish_means, finite, mean_parts, merge_parts
from areakit.operators.reconcile import reconcile

# The mark of a missing price and the words that tell a measure.
MISSING_PRICE = "--"
SURFACE_WORD = "superfície"
MONTHLY_WORD = "mensual"

RENT_KEYS = ["Nom_Barri", "Any", "Nom_Districte", "Codi_Barri", "Codi_Districte"]


def clean_rent(rows: DataFrame, since: int) -> DataFrame:
    """Rows with a numeric price from the year ``since`` on; price and codes typed.

    Prices may come as text, where ``--`` and anything else that is no number
    counts as missing, or as numbers; one that is not finite is no price. Area codes,
    where present, become integers, also from texts such as ``1.0``.
    """
    price = F.col("Preu")
    if isinstance(rows.schema["Preu"].dataType, T.StringType):
        price = F.when(price != MISSING_PRICE, price.try_cast("double"))
    codes = {c: area_code(F.col(c)) for c in ("Codi_Barri", "Codi_Districte") if c in rows.columns}
    return (
        rows.filter(F.col("Any") >= since)
        .withColumns({"Preu": finite(price.cast("double")), **codes})
        .filter(F.col("Preu").isNotNull())
    )


def area_code(code: Column) -> Column:
    """A code as an integer; null where its number is not whole."""
    number = code.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def unusable_prices(rows: DataFrame) -> DataFrame:
    """Values in the price column that are neither finite numbers nor the missing mark, counted."""
    price = F.col("Preu").cast("string")
    return (
        rows.withColumn("Preu", price)
        .filter(price != MISSING_PRICE)
        .filter(finite(price.try_cast("double")).isNull())
        .groupBy("Preu")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _measure(word: str) -> str:
    return f"contains(Lloguer_mitja, '{word}')"


def rent_parts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Unfinished means of both measures by any keys, in one pass over the rows.

    Facts that still lack their area can be reduced by their own key first and
    joined to the area afterwards; :func:`rent_means` adds the parts up.
    """
    return rows.groupBy(*keys).agg(
        *mean_parts("Preu", "surface", _measure(SURFACE_WORD)),
        *mean_parts("Preu", "monthly", _measure(MONTHLY_WORD)),
    )


def rent_means(parts: DataFrame) -> DataFrame:
    """Mean surface and monthly price per area and year that has both."""
    merged = (
        parts.groupBy(*RENT_KEYS)
        .agg(*merge_parts("surface"), *merge_parts("monthly"))
        .filter((F.col("surface_n") > 0) & (F.col("monthly_n") > 0))
    )
    return finish_means(merged, {"surface": "surface_price", "monthly": "monthly_price"})


def rent_two_year(means: DataFrame, current: int, previous: int) -> DataFrame:
    """Rows of the current year whose area also has the previous one.

    A window over the few yearly rows of an area does the self-join's work
    without computing the means twice.
    """
    by_area = Window.partitionBy("Nom_Barri")
    return (
        means.filter(F.col("Any").isin(current, previous))
        .withColumn("_before", F.max(F.col("Any") == previous).over(by_area))
        .filter((F.col("Any") == current) & F.col("_before"))
        .drop("_before")
    )


def rent_yoy(means: DataFrame, current: int, previous: int) -> DataFrame:
    """Both prices of the current year and their increase over the area's previous one.

    Areas are told apart by name and codes; some names occur in several districts.
    """
    by_area = Window.partitionBy("Nom_Barri", "Codi_Barri", "Codi_Districte")

    def increase(column: str) -> Column:
        before = F.max(F.when(F.col("Any") == previous, F.col(column))).over(by_area)
        return F.round(F.col(column) - before, 2)

    return (
        means.filter(F.col("Any").isin(current, previous))
        .select(
            "*",
            increase("surface_price").alias("surface_increase"),
            increase("monthly_price").alias("monthly_increase"),
        )
        .filter((F.col("Any") == current) & F.col("surface_increase").isNotNull())
        .drop("Any")
    )


def rent_profile(two_year: DataFrame, pairs: DataFrame) -> DataFrame:
    """Current rent prices by reconciled name."""
    return reconcile(two_year, pairs, "Nom_Barri").select(
        "neighborhood",
        F.col("Codi_Barri").alias("neighborhood_code"),
        F.col("Nom_Districte").alias("rent_district"),
        F.col("Codi_Districte").alias("district_code"),
        "surface_price",
        "monthly_price",
    )


def area_profile(income: DataFrame, rent: DataFrame) -> DataFrame:
    """Areas known to both sources, with ids, codes, indicators and prices."""
    return income.join(rent, "neighborhood").select(
        "neighborhood",
        "neighborhood_id",
        "neighborhood_code",
        "district_name",
        "district_code",
        "rfd",
        "pop",
        "surface_price",
        "monthly_price",
    )

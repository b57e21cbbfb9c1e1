"""Descriptive indicators over the formatted tables."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit import schemas
from areakit.functions.numbers import (
    finish_means,
    high_bits,
    low_bits,
    mean_parts,
    merge_parts,
    units,
)
from areakit.operators.ordering import with_row_index


def price_by_area(listings: DataFrame, area: str = "neighborhood", price: str = "price") -> DataFrame:
    """Mean price and number of listings per area."""
    merged = listings.groupBy(F.col(area).alias("neighborhood")).agg(
        *mean_parts(f"`{price}`", "price"), F.count(F.lit(1)).alias("n_listings")
    )
    return _priced(merged)


def _priced(merged: DataFrame) -> DataFrame:
    return finish_means(merged, {"price": "average_price"}).select(
        "neighborhood", "average_price", "n_listings"
    )


def price_by_area_nested(nested: DataFrame) -> DataFrame:
    """The same from the nested table, reading the arrays in place."""

    def total(of: str) -> str:
        return f"aggregate(prices, 0L, (sum, price) -> sum + {of})"

    prices = f"filter(transform(`Info Idealista`, x -> {units('x.price')}), c -> c IS NOT NULL)"
    counted = nested.selectExpr(
        "Neighborhood AS neighborhood",
        f"{prices} AS prices",
        "size(`Info Idealista`) AS n_listings",
    ).selectExpr(
        "neighborhood",
        f"{total(high_bits('price'))} AS price_hi",
        f"{total(low_bits('price'))} AS price_lo",
        "size(prices) AS price_n",
        "n_listings",
    )
    return _priced(
        counted.groupBy("neighborhood").agg(
            *merge_parts("price"), F.sum("n_listings").alias("n_listings")
        )
    )


def ranked(kpi: DataFrame) -> DataFrame:
    """Both orders of the dashboard, made explicit, and the price in thousands."""
    kpi = kpi.withColumn("scaled_price", F.col("average_price") / 1000)
    name = F.col("neighborhood").asc()
    by_price = with_row_index(kpi, [F.col("average_price").asc(), name], "price_rank", start=1)
    return with_row_index(by_price, [F.col("n_listings").desc(), name], "listings_rank", start=1)


def rent_income_pairs(nested: DataFrame) -> DataFrame:
    """Monthly rent and income index of every area, once however many parts it has."""
    columns = [schemas.MONTHLY_PRICE, "RFD most recent"]
    return nested.select("Neighborhood", *columns).distinct().select(*columns)


def rent_income_of_listed(profile: DataFrame, listings: DataFrame) -> DataFrame:
    """The same from an area profile, for the areas that have listings.

    The newest copy of a property may move to another area, so ``listings`` are the newest.
    """
    listed = listings.select("neighborhood").distinct()
    return profile.join(listed, "neighborhood", "left_semi").select(
        F.col("monthly_price").alias(schemas.MONTHLY_PRICE), F.col("rfd").alias("RFD most recent")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation of two columns to three decimals; null for a single row."""
    return df.agg(F.round(F.corr(F.col(f"`{x}`"), F.col(f"`{y}`")), 3).alias("correlation"))


def correlation_matrix(df: DataFrame) -> DataFrame:
    """Correlations of all numeric columns in long form, from one aggregation."""
    names = numeric_columns(df)
    pairs = list(combinations_with_replacement(names, 2))
    one_row = df.agg(
        *(
            F.round(F.corr(F.col(f"`{x}`"), F.col(f"`{y}`")), 3).alias(f"_{i}")
            for i, (x, y) in enumerate(pairs)
        )
    )
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"_{i}").alias("correlation"))
        for i, (x, y) in enumerate(pairs)
        for a, b in {(x, y), (y, x)}
    ]
    return one_row.select(F.inline(F.array(*cells)))

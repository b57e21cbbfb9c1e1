"""Reconciliation lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit import schemas
from areakit.functions.names import strip_quotes
from areakit.operators.nesting import nest


def read_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON-lines lookup; names lose the literal quotes some are wrapped in."""
    lookup = spark.read.schema(schema).json(path)
    return clean_lookup(lookup)


def clean_lookup(lookup: DataFrame) -> DataFrame:
    names = [
        f.name for f in lookup.schema.fields if isinstance(f.dataType, T.StringType) and f.name != "_id"
    ]
    return lookup.withColumns({c: strip_quotes(F.col(c)) for c in names})


def read_extended_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The wide CSV lookup that carries districts and neighborhoods together."""
    return spark.read.schema(schemas.EXTENDED_LOOKUP).option("header", True).option(
        "escape", '"'
    ).csv(path)


def repeated_names(lookup: DataFrame, raw: str) -> DataFrame:
    """Raw names with more than one lookup row; joins would repeat their matches."""
    return lookup.groupBy(raw).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def neighborhood_lookup(extended: DataFrame) -> DataFrame:
    """The neighborhood lookup contained in an extended one."""
    return extended.select(
        F.col("neighborhood_id").alias("_id"),
        "neighborhood",
        F.col("neighborhood_n").alias("neighborhood_name"),
        F.col("neighborhood_n_reconciled").alias("neighborhood_reconciled"),
    ).distinct()


def district_lookup(extended: DataFrame, parts: int = 1) -> DataFrame:
    """Districts with the ids of their neighborhoods, in the shape of the district lookup.

    With several ``parts`` a district has a row for each of them that holds any.
    """
    columns = ["district_id", "district", "district_n", "district_n_reconciled"]
    pairs = extended.select(*columns, "neighborhood_id").distinct()
    nested = nest(pairs, columns, F.col("neighborhood_id"), "ids", "neighborhood_id", parts)
    return nested.select(
        F.col("district_id").alias("_id"),
        "district",
        F.col("district_n").alias("district_name"),
        F.col("district_n_reconciled").alias("district_reconciled"),
        F.col("ids").alias("neighborhood_id"),
        "part",
    )

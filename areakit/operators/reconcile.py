"""Replacing a source's spelling of an area by the reconciled name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_pairs(lookup: DataFrame, raw: str, reconciled: str, area_id: str | None = None) -> DataFrame:
    """A lookup reduced to ``raw_name, neighborhood`` and optionally its id."""
    columns = [F.col(raw).alias("raw_name"), F.col(reconciled).alias("neighborhood")]
    if area_id:
        columns.append(F.col(area_id).alias("neighborhood_id"))
    return lookup.select(*columns)


def reconcile(df: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Inner join on the raw spelling in column ``name``, which is replaced.

    Rows whose spelling the lookup does not know are left out, as reported by
    :func:`unmatched`.
    """
    source = df.withColumnRenamed(name, "raw_name")
    return source.join(pairs, "raw_name").drop("raw_name")


def unmatched(df: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Spellings without a lookup row and how many rows each one has.

    Names are counted before the join, so only distinct names are shuffled to it.
    """
    names = df.groupBy(F.col(name).alias("raw_name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return names.join(pairs, "raw_name", "left_anti")

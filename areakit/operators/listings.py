"""Property listings: scope, reconciliation, latest copy, joining to area profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areakit import schemas
from areakit.operators.latest import latest
from areakit.operators.nesting import nest
from areakit.operators.reconcile import reconcile

PROVINCE = "Barcelona"


def in_scope(listings: DataFrame, province: str = PROVINCE) -> DataFrame:
    return listings.filter(F.col("province") == province)


def reconciled_listings(
    listings: DataFrame, pairs: DataFrame, province: str = PROVINCE
) -> DataFrame:
    """Listings of one province under their reconciled area name.

    Columns beyond the published ones (tie-breakers) are kept.
    """
    return reconcile(in_scope(listings, province), pairs, "neighborhood")


def latest_listings(listings: DataFrame, tie_breakers: list[str]) -> DataFrame:
    """The newest copy of each property. ``tie_breakers`` decide within a day."""
    return latest(listings, ["propertyCode"], ["date", *tie_breakers])


def flat_table(listings: DataFrame, profile: DataFrame) -> DataFrame:
    """One row per listing with its area's profile, under the published names.

    Of a settled profile Spark knows the size: it is broadcast below the threshold, and
    above it large areas are split by the skewed-join rule.
    """
    joined = listings.join(profile, "neighborhood")
    return joined.select(*(F.col(c).alias(name) for name, c in schemas.FLAT_COLUMNS.items()))


def nested_table(listings: DataFrame, profile: DataFrame, parts: int) -> DataFrame:
    """Each area's listings as arrays, under the published names.

    One row per area and ``Info Part`` (0 to ``parts`` - 1) that holds any; see
    :func:`areakit.operators.nesting.nest`.
    """
    info = F.struct("propertyCode", *schemas.LISTING_FIELDS)
    nested = nest(listings, ["neighborhood"], info, "info", "propertyCode", parts)
    joined = nested.join(profile, "neighborhood")
    return joined.select(*(F.col(c).alias(name) for name, c in schemas.NESTED_COLUMNS.items()))

"""From the persistent landing zone to the formatted tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from areakit import schemas
from areakit.operators.income import income_profile, unusable_income, with_most_recent
from areakit.operators.listings import (
    PROVINCE,
    flat_table,
    in_scope,
    latest_listings,
    nested_table,
    reconciled_listings,
)
from areakit.operators.nesting import check_parts
from areakit.operators.reconcile import lookup_pairs, unmatched
from areakit.operators.rent import (
    RENT_KEYS,
    area_profile,
    clean_rent,
    rent_means,
    rent_parts,
    rent_profile,
    rent_two_year,
    unusable_prices,
)
from areakit.session import settle
from areakit.sources.lookups import repeated_names
from areakit.sources.tables import overwrite_table

CURRENT_YEAR = 2021
PREVIOUS_YEAR = 2020


@dataclass(frozen=True)
class Landing:
    """The sources of one integration run."""

    income: DataFrame
    rent: DataFrame
    listings: DataFrame
    income_lookup: DataFrame
    rent_lookup: DataFrame


def build_profile(
    landing: Landing, current: int = CURRENT_YEAR, previous: int = PREVIOUS_YEAR
) -> DataFrame:
    names = lookup_pairs(landing.income_lookup, "neighborhood", "neighborhood_reconciled")
    with_ids = lookup_pairs(landing.income_lookup, "neighborhood", "neighborhood_reconciled", "_id")
    means = rent_means(rent_parts(clean_rent(landing.rent, previous), RENT_KEYS))
    rent = rent_profile(rent_two_year(means, current, previous), names)
    return area_profile(income_profile(landing.income, with_ids), rent)


def build_listings(
    landing: Landing, tie_breakers: list[str], province: str = PROVINCE
) -> DataFrame:
    pairs = lookup_pairs(landing.rent_lookup, "ne", "ne_re")
    return latest_listings(reconciled_listings(landing.listings, pairs, province), tie_breakers)


def integrate(
    landing: Landing,
    tie_breakers: list[str],
    parts: int,
    province: str = PROVINCE,
    current: int = CURRENT_YEAR,
    previous: int = PREVIOUS_YEAR,
) -> tuple[DataFrame, DataFrame]:
    """The flat and the nested formatted table, the latter with each area in ``parts`` rows at most.

    Listings and profile feed both, so each is computed once. Fails before nesting if a part
    of some area has more listings than an array may hold.
    """
    columns = ["neighborhood", "propertyCode", *schemas.LISTING_FIELDS]
    listings = settle(build_listings(landing, tie_breakers, province).select(*columns))
    check_parts(listings, ["neighborhood"], "propertyCode", parts)
    profile = settle(build_profile(landing, current, previous))
    return flat_table(listings, profile), nested_table(listings, profile, parts)


def integration_rejects(
    landing: Landing, province: str = PROVINCE, previous: int = PREVIOUS_YEAR
) -> DataFrame:
    """What :func:`integrate` leaves out or would repeat: ``kind``, ``value`` and ``n_rows``.

    Names without a lookup row, prices and income values that are no finite numbers, and
    lookup names that occur more than once.
    """
    income_pairs = lookup_pairs(landing.income_lookup, "neighborhood", "neighborhood_reconciled")
    rent_pairs = lookup_pairs(landing.rent_lookup, "ne", "ne_re")
    used = landing.rent.filter(F.col("Any") >= previous)
    found = {
        "listing name": unmatched(in_scope(landing.listings, province), rent_pairs, "neighborhood"),
        "income name": unmatched(with_most_recent(landing.income), income_pairs, "name"),
        "rent name": unmatched(clean_rent(landing.rent, previous), income_pairs, "Nom_Barri"),
        "rent price": unusable_prices(used),
        "income value": unusable_income(landing.income).groupBy("name").agg(F.count(F.lit(1)).alias("n_rows")),
        "income lookup name": repeated_names(landing.income_lookup, "neighborhood"),
        "rent lookup name": repeated_names(landing.rent_lookup, "ne"),
    }
    named = [
        df.toDF("value", "n_rows").select(F.lit(kind).alias("kind"), F.col("value").cast("string"), "n_rows")
        for kind, df in found.items()
    ]
    return reduce(DataFrame.unionAll, named)


def publish_formatted(flat: DataFrame, nested: DataFrame, zone: str, fmt: str = "parquet") -> dict[str, int]:
    """Write both formatted tables; returns what the writes themselves counted.

    ``flat_rows``, ``nested_rows`` (areas and their parts) and ``nested_listings``.
    """
    flat_seen, nested_seen = Observation("flat"), Observation("nested")
    listings = F.sum(F.size("Info Idealista"))
    counted = nested.observe(nested_seen, F.count(F.lit(1)).alias("nested_rows"), listings.alias("nested_listings"))
    overwrite_table(counted, f"{zone}/nested_data", fmt)
    overwrite_table(flat.observe(flat_seen, F.count(F.lit(1)).alias("flat_rows")), f"{zone}/data", fmt)
    found = {**flat_seen.get, **nested_seen.get}
    return {name: int(value or 0) for name, value in found.items()}

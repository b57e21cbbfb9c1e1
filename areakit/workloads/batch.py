"""Registered batch queries over the formatted side: cleaning to indicators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areakit import schemas
from areakit.functions.names import normalize_name
from areakit.functions.numbers import cents
from areakit.operators import kpi
from areakit.operators.income import with_most_recent
from areakit.operators.latest import latest, latest_by_aggregate
from areakit.operators.listings import flat_table, in_scope, nested_table
from areakit.operators.reconcile import lookup_pairs, unmatched
from areakit.operators.rent import clean_rent, rent_two_year, rent_yoy
from areakit.plans.exploitation import publish_indicators
from areakit.plans.integration import Landing, integrate, integration_rejects, publish_formatted
from areakit.session import scratch, settle
from areakit.sources.lookups import district_lookup
from areakit.sources.tables import read_table
from areakit.workloads import roles

LISTING_COLUMNS = ["propertyCode", *schemas.LISTING_FIELDS]


def select_rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders")
    return (
        orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
        .withColumnRenamed("o_totalprice", "price")
        .withColumnsRenamed({"o_orderkey": "listing_id", "o_custkey": "property_code"})
        .withColumns(
            {
                "property_code": F.col("property_code").cast("string"),
                "o_orderdate": F.col("o_orderdate").cast("date"),
                "o_orderpriority": F.substring("o_orderpriority", 1, 1).try_cast("int"),
            }
        )
        .toDF("listing_id", "property_code", "price", "date", "rooms")
    )


def filter_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_rent(
        roles.rent_facts(spark, sf_dir, as_text=True), roles.PREVIOUS_YEAR
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "Any", "Lloguer_mitja", F.col("Preu").alias("price")
    )


def filter_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_scope(roles.listings(spark, sf_dir), roles.PROVINCE).select(
        "listing_id", "propertyCode", "neighborhood", "price"
    )


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        roles.table(spark, sf_dir, "lineitem")
        .select("l_suppkey", F.year("l_shipdate").alias("year"), "l_returnflag")
        .distinct()
    )


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.table(spark, sf_dir, "documents").select(
        "doc_id", normalize_name(F.col("text")).alias("normalized")
    )


def lookup_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    districts = district_lookup(roles.extended_lookup(spark, sf_dir), roles.PARTS)
    return districts.withColumn("neighborhood_id", F.array_join("neighborhood_id", ","))


def reconcile_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.scoped_listings(spark, sf_dir).select(
        "listing_id", "neighborhood", *LISTING_COLUMNS
    )


def reconcile_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = lookup_pairs(roles.rent_lookup(spark, sf_dir), "ne", "ne_re")
    return unmatched(roles.listings(spark, sf_dir), pairs, "neighborhood")


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.scoped_listings(spark, sf_dir).drop("province")
    return latest_by_aggregate(rows, ["propertyCode"], ["date", *roles.TIE_BREAKERS]).select(
        "neighborhood", *LISTING_COLUMNS
    )


def dedupe_latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.scoped_listings(spark, sf_dir).drop("province")
    return latest(rows, ["propertyCode"], ["date", *roles.TIE_BREAKERS]).select(
        "neighborhood", *LISTING_COLUMNS
    )


def income_nest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly array written out as text, values in cents."""
    text = f"transform(info, x -> concat_ws(':', x.year, {cents('x.RFD')}, x.pop))"
    return roles.income_documents(spark, sf_dir).select(
        F.col(schemas.INCOME_NAME).alias("neigh_name"),
        "district_name",
        F.array_join(F.expr(text), ";").alias("info"),
    )


def most_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_most_recent(roles.income_documents(spark, sf_dir))


def income_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.income_side(spark, sf_dir)


def rent_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.yearly_rent(spark, sf_dir)


def rent_two_year_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rent_two_year(
        roles.yearly_rent(spark, sf_dir), roles.CURRENT_YEAR, roles.PREVIOUS_YEAR
    )


def rent_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rent_yoy(roles.yearly_rent(spark, sf_dir), roles.CURRENT_YEAR, roles.PREVIOUS_YEAR)


def rent_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.rent_side(spark, sf_dir)


def area_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.profile(spark, sf_dir)


def integrated_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_table(roles.newest_listings(spark, sf_dir), settle(roles.profile(spark, sf_dir)))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["neighborhood", "propertyCode", *schemas.LISTING_FIELDS]
    listings = settle(roles.newest_listings(spark, sf_dir).select(*columns))
    return nested_table(listings, settle(roles.profile(spark, sf_dir)), roles.PARTS)


def nested_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing array written out as text: code, date, price in cents, rooms."""
    parts = f"x.propertyCode, x.date, {cents('x.price')}, x.rooms, x.floor"
    text = F.expr(f"transform(`Info Idealista`, x -> concat_ws('|', {parts}))")
    return _nested(spark, sf_dir).withColumn("Info Idealista", F.array_join(text, ";"))


def _landing(spark: SparkSession, sf_dir: str) -> Landing:
    """All sources of the integration, rent facts placed in their areas."""
    suppliers = (
        roles.table(spark, sf_dir, "supplier")
        .join(roles.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(roles.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    areas = suppliers.select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.col("n_name").alias("Nom_Barri"),
        F.col("r_name").alias("Nom_Districte"),
        F.col("n_nationkey").alias("Codi_Barri"),
        F.col("r_regionkey").alias("Codi_Districte"),
    )
    return Landing(
        roles.income_documents(spark, sf_dir),
        roles.rent_facts(spark, sf_dir, as_text=True).join(areas, "l_suppkey"),
        roles.listings(spark, sf_dir),
        roles.income_lookup(spark, sf_dir),
        roles.rent_lookup(spark, sf_dir),
    )


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What integration leaves out, with unreadable prices and a repeated lookup name planted."""
    landing = _landing(spark, sf_dir)
    price = F.when(F.col("l_linenumber") == roles.UNREADABLE_LINE, roles.UNREADABLE).otherwise(F.col("Preu"))
    names = landing.income_lookup
    again = names.filter(F.col("_id") == f"Q{roles.REPEATED}").withColumn("_id", F.lit("again"))
    planted = replace(landing, rent=landing.rent.withColumn("Preu", price), income_lookup=names.unionByName(again))
    return integration_rejects(planted, roles.PROVINCE, roles.PREVIOUS_YEAR)


def published(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    """The whole integration, written to a formatted zone, with the counts of its writes."""
    zone = scratch(spark, "formatted")
    flat, nested = integrate(
        _landing(spark, sf_dir), roles.TIE_BREAKERS, roles.PARTS, roles.PROVINCE, roles.CURRENT_YEAR, roles.PREVIOUS_YEAR
    )
    return zone, publish_formatted(flat, nested, zone)


def integration_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the writes of the formatted tables counted on their way."""
    _, counts = published(spark, sf_dir)
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


def published_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicator tables that follow the formatted zone, joined by rent and area."""
    zone, _ = published(spark, sf_dir)
    target = scratch(spark, "exploitation")
    publish_indicators(spark, zone, target)
    pairs = read_table(spark, f"{target}/kpi2").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.max("Monthly Price (€/month)").alias("highest_rent")
    )
    return read_table(spark, f"{target}/kpi1").crossJoin(F.broadcast(pairs))  # one row


def kpi1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.price_by_area(roles.newest_listings(spark, sf_dir))


def kpi1_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.price_by_area_nested(_nested(spark, sf_dir))


def kpi1_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.ranked(kpi1(spark, sf_dir))


def kpi2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the areas that have listings, as the nested table holds them."""
    return kpi.rent_income_of_listed(
        roles.profile(spark, sf_dir), roles.newest_listings(spark, sf_dir)
    )


def kpi2_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = kpi2_pairs(spark, sf_dir)
    x, y = kpi.numeric_columns(pairs)
    return kpi.correlation(pairs, x, y)


def kpi2_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.correlation_matrix(
        roles.profile(spark, sf_dir).select("rfd", "pop", "surface_price", "monthly_price")
    )


QUERIES = {
    "kpi1": kpi1,
    "select_rename_cast": select_rename_cast,
    "filter_clean": filter_clean,
    "filter_scope": filter_scope,
    "distinct_rows": distinct_rows,
    "normalize_names": normalize_names,
    "lookup_districts": lookup_districts,
    "reconcile_listings": reconcile_listings,
    "reconcile_unmatched": reconcile_unmatched,
    "dedupe_latest": dedupe_latest,
    "dedupe_latest_window": dedupe_latest_window,
    "income_nest": income_nest,
    "most_recent": most_recent,
    "income_profile": income_profile,
    "rent_means": rent_means,
    "rent_two_year": rent_two_year_rows,
    "rent_yoy": rent_increase,
    "rent_profile": rent_profile,
    "area_profile": area_profile,
    "integrated_flat": integrated_flat,
    "nested_listings": nested_listings,
    "integration_counts": integration_counts,
    "integration_rejects": rejects,
    "published_indicators": published_indicators,
    "kpi1_nested": kpi1_nested,
    "kpi1_ranked": kpi1_ranked,
    "kpi2_pairs": kpi2_pairs,
    "kpi2_corr": kpi2_corr,
    "kpi2_corr_matrix": kpi2_corr_matrix,
}

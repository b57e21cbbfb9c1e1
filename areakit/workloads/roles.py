"""The test tables in the roles of the library's sources.

Orders are the listings (the customer is the property, its nation the area),
order lines are the rent facts (by the supplier's nation), customers weighted by
their orders are the income reports, nations are the lookups, parts are what the
model learns from, and events are the messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit import schemas
from areakit.functions.names import normalize_name
from areakit.functions.numbers import finish_means, weighted_parts
from areakit.operators.income import income_profile, nest_income
from areakit.operators.listings import latest_listings, reconciled_listings
from areakit.operators.reconcile import lookup_pairs
from areakit.operators.rent import (
    MISSING_PRICE,
    area_profile,
    clean_rent,
    rent_means,
    rent_parts,
    rent_profile,
    rent_two_year,
)
from areakit.sources.tables import read_table

CURRENT_YEAR = 2001
PREVIOUS_YEAR = 2000
PROVINCE = "F"
TIE_BREAKERS = ["listing_id"]
UNSTATED = "No consta"
PARTS = 3
BLANK_EVERY, NAN_EVERY = 7, 11
# Planted for the report of what integration leaves out.
UNREADABLE, UNREADABLE_LINE, REPEATED = "n/d", 7, 3

SURFACE_KIND = "Lloguer mitjà per superfície (Euros/m2 mes)"
MONTHLY_KIND = "Lloguer mitjà mensual (Euros/mes)"
CONTRACT_KIND = "Nombre de contractes"


_TYPES = {
    "i": T.IntegerType(),
    "l": T.LongType(),
    "d": T.DoubleType(),
    "s": T.StringType(),
    "t": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


TABLES = {
    "region": _schema(r_regionkey="i", r_name="s"),
    "nation": _schema(n_nationkey="i", n_name="s", n_regionkey="i"),
    "customer": _schema(
        c_custkey="l", c_name="s", c_nationkey="i", c_acctbal="d", c_mktsegment="s"
    ),
    "supplier": _schema(s_suppkey="l", s_name="s", s_nationkey="i", s_acctbal="d"),
    "part": _schema(
        p_partkey="l", p_name="s", p_brand="s", p_type="s", p_size="i", p_retailprice="d"
    ),
    "orders": _schema(
        o_orderkey="l",
        o_custkey="l",
        o_orderstatus="s",
        o_totalprice="d",
        o_orderdate="t",
        o_orderpriority="s",
    ),
    "lineitem": _schema(
        l_orderkey="l",
        l_partkey="l",
        l_suppkey="l",
        l_linenumber="i",
        l_quantity="d",
        l_extendedprice="d",
        l_discount="d",
        l_tax="d",
        l_returnflag="s",
        l_linestatus="s",
        l_shipdate="t",
    ),
    "events": _schema(event_id="l", ts="t", user_id="l", event_type="s", value="d", props="s"),
    "documents": _schema(doc_id="l", text="s", lang="s", source="s", n_chars="l"),
    "pages": _schema(page_id="l", url="s", html="s"),
    "benchmark": _schema(item_id="l", text="s"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by its declared schema, so no footer is read to plan a query."""
    return read_table(spark, f"{sf_dir}/{name}.parquet", schema=TABLES[name])


def reconciled_name(raw: Column) -> Column:
    return F.initcap(F.replace(F.lower(raw), F.lit("_"), F.lit(" ")))


def income_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw names as income and rent sources spell them."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("_id"),
        F.col("n_name").alias("neighborhood"),
        normalize_name(F.col("n_name")).alias("neighborhood_name"),
        reconciled_name(F.col("n_name")).alias("neighborhood_reconciled"),
    )


def listing_spelling(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit("-"))


def rent_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw names as listings spell them."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("_id"),
        listing_spelling(F.col("n_name")).alias("ne"),
        normalize_name(F.col("n_name")).alias("ne_n"),
        reconciled_name(F.col("n_name")).alias("ne_re"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings; the area of an order without a priority is unstated."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    priority = F.col("o_orderpriority")
    return joined.select(
        F.col("o_custkey").cast("string").alias("propertyCode"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderstatus").alias("province"),
        F.when(priority == "4-NOT SPECIFIED", UNSTATED)
        .otherwise(listing_spelling(F.col("n_name")))
        .alias("neighborhood"),
        F.col("o_totalprice").alias("price"),
        F.col("c_acctbal").alias("size"),
        F.substring(priority, 1, 1).cast("int").alias("rooms"),
        F.col("n_regionkey").alias("bathrooms"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        F.col("o_orderstatus").alias("operation"),
        F.col("c_mktsegment").alias("propertyType"),
        priority.alias("floor"),
        F.col("o_orderkey").alias("listing_id"),
    )


def scoped_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciled listings of the province."""
    pairs = lookup_pairs(rent_lookup(spark, sf_dir), "ne", "ne_re")
    return reconciled_listings(listings(spark, sf_dir), pairs, PROVINCE)


def newest_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_listings(scoped_listings(spark, sf_dir), TIE_BREAKERS)


def rent_kind(flag: Column) -> Column:
    return F.when(flag == "A", SURFACE_KIND).when(flag == "R", MONTHLY_KIND).otherwise(CONTRACT_KIND)


def rent_facts(
    spark: SparkSession, sf_dir: str, since: int = PREVIOUS_YEAR, as_text: bool = False
) -> DataFrame:
    """Rent rows still keyed by supplier; contract counts carry no price.

    Prices have four decimals. They are numbers, or text with a mark for the missing ones. The date bound
    says what ``Any`` will be filtered by, in a form the Parquet reader can skip
    row groups with.
    """
    flag = F.col("l_returnflag")
    price = F.when(flag != "N", F.col("l_extendedprice") * F.col("l_discount"))
    if as_text:
        price = F.coalesce(price.cast("string"), F.lit(MISSING_PRICE))
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_shipdate") >= F.lit(f"{since}-01-01").cast("timestamp_ntz"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_suppkey",
            F.year("l_shipdate").alias("Any"),
            rent_kind(flag).alias("Lloguer_mitja"),
            price.alias("Preu"),
        )
    )


def yearly_rent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean rents by area and year.

    Facts are reduced to one row per supplier and year before they meet the
    supplier table, so neither a large supplier nor the raw rows are shuffled.
    """
    facts = clean_rent(rent_facts(spark, sf_dir), PREVIOUS_YEAR)
    parts = rent_parts(facts, ["l_suppkey", "Any"])
    placed = (
        parts.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnsRenamed(
            {
                "n_name": "Nom_Barri",
                "r_name": "Nom_Districte",
                "n_nationkey": "Codi_Barri",
                "r_regionkey": "Codi_Districte",
            }
        )
    )
    return rent_means(placed)


def income_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income rows by area and year: mean balance and number of orders.

    Orders are counted per customer and year before the join with customers.
    """
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("Any"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    merged = (
        counts.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("Any", "n_nationkey", "n_name", "n_regionkey")
        .agg(*weighted_parts("c_acctbal", "n_orders", "index"))
    )
    indexed = finish_means(merged.withColumn("pop", F.col("index_n").cast("string")), {"index": "rfd"})
    return indexed.join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        "Any",
        F.col("r_regionkey").alias("Codi_Districte"),
        F.col("r_name").alias("Nom_Districte"),
        F.col("n_nationkey").alias("Codi_Barri"),
        F.col("n_name").alias("Nom_Barri"),
        "pop",
        F.col("rfd").cast("string").alias("RFD"),
    )


def income_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest_income(income_reports(spark, sf_dir))


def income_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = lookup_pairs(
        income_lookup(spark, sf_dir), "neighborhood", "neighborhood_reconciled", "_id"
    )
    return income_profile(income_documents(spark, sf_dir), pairs)


def rent_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = lookup_pairs(income_lookup(spark, sf_dir), "neighborhood", "neighborhood_reconciled")
    two_year = rent_two_year(yearly_rent(spark, sf_dir), CURRENT_YEAR, PREVIOUS_YEAR)
    return rent_profile(two_year, pairs)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area_profile(income_side(spark, sf_dir), rent_side(spark, sf_dir))


def extended_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as neighborhoods of their nation."""
    joined = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("n_name").alias("district"),
        F.col("s_name").alias("neighborhood"),
        reconciled_name(F.col("n_name")).alias("district_n_reconciled"),
        normalize_name(F.col("n_name")).alias("district_n"),
        F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("district_id"),
        F.col("s_name").alias("neighborhood_n_reconciled"),
        normalize_name(F.col("s_name")).alias("neighborhood_n"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("neighborhood_id"),
    ).select(*schemas.EXTENDED_LOOKUP.names)


def rooms_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as priced flats: the brand is the area, the size the rooms."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_brand").alias("Neighborhood_ID"),
        F.col("p_retailprice").alias("Price"),
        F.col("p_size").alias("Rooms"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as message text; errors lack a price and sign-ups have a bad one.

    Of the others, some have a blank area and some a price that is no finite number.
    """
    kind, number = F.col("event_type"), F.col("event_id")
    area = F.when(~kind.isin("error", "signup") & (number % BLANK_EVERY == 0), " ").otherwise(kind)
    head = F.concat_ws(",", number.cast("string"), area)
    cents_text = F.rint(F.col("value") * 100).cast("bigint").cast("string")
    odd = (number % BLANK_EVERY != 0) & (number % NAN_EVERY == 0)
    cents_text = F.when(odd, "NaN").otherwise(cents_text)
    return table(spark, sf_dir, "events").select(
        F.when(kind == "error", head)
        .when(kind == "signup", F.concat_ws(",", head, F.lit("n/a")))
        .otherwise(F.concat_ws(",", head, cents_text))
        .alias("value")
    )


def part_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rooms_rows(spark, sf_dir).select(
        F.concat_ws(
            ",", F.col("p_partkey").cast("string"), "Neighborhood_ID", F.col("Price").cast("string")
        ).alias("value")
    )

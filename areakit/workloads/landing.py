"""Registered queries that write landing files from the tables and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit import schemas
from areakit.functions.names import normalize_name
from areakit.functions.paths import report_year
from areakit.operators.nesting import nest
from areakit.session import scratch
from areakit.sources import lookups, portal, reports, snapshots
from areakit.sources.tables import overwrite_partitions, overwrite_table, read_table
from areakit.workloads import roles

# Reports before this year lack the priority column; the first ones also have
# other dialects.
NEW_FORMAT_YEAR = 1998
LAST_SEMICOLON_YEAR = 1995
FIRST_YEAR, END_YEAR = 1990, 2005
# Planted: records of two lines, and stray quotes.
TWO_LINES_EVERY = 5
STRAY_YEAR, STRAY_EVERY = 1997, 10
# Of the dated layout: one month, and what picks some months.
MONTH, LARGEST_QUANTITY = "1997-05-01", 50
# Years in which snapshots change their types.
WHOLE_YEAR, TEXT_YEAR = 1997, 1999
TOPIC = "lloguer_preu"


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings replace what the sink held before, and then those of one status are replaced alone."""
    path = scratch(spark, "overwrite")
    rows = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    overwrite_table(rows.limit(10), path)
    overwrite_table(rows.filter(F.col("o_orderstatus") != "O"), path, partition_by=["o_orderstatus"])
    again = rows.filter(F.col("o_orderstatus") == roles.PROVINCE).withColumn("o_totalprice", -F.col("o_totalprice"))
    overwrite_partitions(again, path, ["o_orderstatus"])
    return read_table(spark, path, schema=rows.schema)


def _orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders")
    return orders.select(
        F.year("o_orderdate").alias("Any"),
        F.col("o_orderkey").alias("Codi"),
        F.col("o_custkey").alias("Propietat"),
        F.rint(F.col("o_totalprice") * 100).cast("bigint").alias("Població"),
        F.col("o_orderpriority").alias("Prioritat"),
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dialect and one set of columns: the plain CSV reader with a schema."""
    path = scratch(spark, "reports")
    rows = _orders_by_year(spark, sf_dir)
    reports.write_reports(rows, path, "Any", TOPIC)
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("report", T.StringType())]
    )
    return spark.read.schema(schema).option("header", True).csv(path)


def _write_unquoted(rows: DataFrame, path: str) -> None:
    """Reports whose quotes are written as they are, as no careful writer would."""
    named = rows.withColumn("report", reports.report_name(F.col("Any"), TOPIC))
    plain = named.hint("rebalance", "report").write.option("header", True).option("quote", "\u0000")
    plain.partitionBy("report").csv(path)


def csv_yearly_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years with different columns, united by name.

    Of the new ones, some records go over two lines, and odd years have inch marks in
    fields without quotes.
    """
    path = scratch(spark, "yearly")
    rows = _orders_by_year(spark, sf_dir)
    old = rows.filter(F.col("Any") < NEW_FORMAT_YEAR).drop("Prioritat")
    new = rows.filter(F.col("Any") >= NEW_FORMAT_YEAR).select(*reversed(rows.columns))
    odd = F.col("Any") % 2 == 1
    two_lines = F.when(F.col("Codi") % TWO_LINES_EVERY == 0, F.concat("Prioritat", F.lit("\nurgent"))).otherwise(F.col("Prioritat"))
    inches = F.concat(F.lit('3" '), "Prioritat")
    reports.write_reports(old, f"{path}/old", "Any", TOPIC)
    reports.write_reports(new.filter(~odd).withColumn("Prioritat", two_lines), f"{path}/new", "Any", TOPIC)
    _write_unquoted(new.filter(odd).withColumn("Prioritat", inches), f"{path}/odd")
    read = reports.read_reports(spark, path, rows.columns)
    return read.select(
        report_year(F.col("file")).alias("year"),
        *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in rows.schema.fields),
    )


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines spoilt by stray quotes, planted in one year, and the rows read all the same."""
    path = scratch(spark, "rejects")
    rows = _orders_by_year(spark, sf_dir)
    stray = (F.col("Any") == STRAY_YEAR) & (F.col("Codi") % STRAY_EVERY == 0)
    rows = rows.withColumn("Prioritat", F.when(stray, F.concat(F.lit('"'), "Prioritat")).otherwise(F.col("Prioritat")))
    _write_unquoted(rows, path)
    year = report_year(F.col("file")).alias("year")
    spoilt = reports.spoilt_lines(spark, path).groupBy(year).agg(F.sum("n_lines").alias("n_lines"))
    read = reports.read_reports(spark, path, ["Codi"]).groupBy(year).agg(F.count(F.lit(1)).alias("n_rows"))
    return read.join(spoilt, "year", "left").select("year", "n_rows", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def csv_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three dialects in one folder; text with accents survives each, and line breaks do."""
    path = scratch(spark, "dialects")
    rows = _orders_by_year(spark, sf_dir).withColumn(
        "Prioritat", F.concat(F.lit("Àrea; "), F.col("Prioritat"), F.lit(', "ü"'))
    )
    year = F.col("Any")
    semicolon = rows.filter(year <= LAST_SEMICOLON_YEAR)
    legacy = rows.filter((year > LAST_SEMICOLON_YEAR) & (year < NEW_FORMAT_YEAR))
    legacy = legacy.withColumn("Prioritat", F.concat("Prioritat", F.lit("\nç")))
    current = rows.filter(year >= NEW_FORMAT_YEAR)
    reports.write_reports(semicolon, f"{path}/a", "Any", TOPIC, ";", reports.LEGACY_ENCODING)
    reports.write_reports(legacy, f"{path}/b", "Any", TOPIC, ",", reports.LEGACY_ENCODING)
    reports.write_reports(current, f"{path}/c", "Any", TOPIC)
    read = reports.read_reports(spark, path, rows.columns)
    return read.select(
        *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in rows.schema.fields)
    )


def json_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly reports as one collection of JSON objects keyed by row index."""
    source, target = scratch(spark, "yearly"), scratch(spark, "indexed")
    rows = _orders_by_year(spark, sf_dir)
    reports.write_reports(rows, source, "Any", TOPIC)
    schema = T.StructType([*rows.schema.fields, T.StructField("report", T.StringType())])
    read = spark.read.schema(schema).option("header", True).csv(source)
    reports.write_indexed_json(read, target, ["report", "Codi"])
    return reports.read_indexed_json(spark, target, schema)


def missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "reports")
    rows = _orders_by_year(spark, sf_dir)
    reports.write_reports(rows, path, "Any", TOPIC)
    return portal.missing_years(portal.present_files(spark, path), FIRST_YEAR, END_YEAR)


def lookup_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a JSON-lines lookup; some names are written inside quotes."""
    path = scratch(spark, "lookup")
    name = F.col("s_name")
    quoted = F.when(F.col("s_acctbal") < 0, F.concat(F.lit('"'), name, F.lit('"'))).otherwise(name)
    supplier = roles.table(spark, sf_dir, "supplier")
    supplier.select(
        F.col("s_suppkey").cast("string").alias("_id"),
        quoted.alias("neighborhood"),
        normalize_name(quoted).alias("neighborhood_name"),
        quoted.alias("neighborhood_reconciled"),
    ).write.json(path)
    return lookups.read_lookup(spark, path, schemas.INCOME_LOOKUP)


def _raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings in the delivered schema, with the month they were seen in."""
    rows = roles.listings(spark, sf_dir)
    return rows.select(
        "propertyCode",
        "price",
        "propertyType",
        "operation",
        "rooms",
        "province",
        "neighborhood",
        "floor",
        F.struct(
            F.col("propertyType").alias("typology"), F.col("operation").alias("subTypology")
        ).alias("detailedType"),
        F.date_format("date", "yyyy_MM_'01'").alias("snapshot"),
        "listing_id",
    )


def _seen(df: DataFrame) -> DataFrame:
    return df.select(
        "date",
        "propertyCode",
        "price",
        "rooms",
        "neighborhood",
        "floor",
        F.col("detailedType.typology").alias("typology"),
        F.col("detailedType.subTypology").alias("sub_typology"),
    )


def _snapshots(spark: SparkSession, sf_dir: str) -> str:
    """Monthly Parquet snapshots, whose columns and types change over the years.

    Those of the first year have no neighborhood; a later year has whole prices, and
    another one writes prices and rooms as text.
    """
    path = scratch(spark, "snapshots")
    rows = _raw_listings(spark, sf_dir)
    year = F.left("snapshot", F.lit(4)).cast("int")
    first, whole, text = year < 1996, year == WHOLE_YEAR, year == TEXT_YEAR
    parts = {
        "early": rows.filter(first).drop("neighborhood"),
        "late": rows.filter(~first & ~whole & ~text),
        "whole": rows.filter(whole).withColumns({"price": F.col("price").cast("long"), "rooms": F.col("rooms").cast("long")}),
        "text": rows.filter(text).withColumns({"price": F.col("price").cast("string"), "rooms": F.col("rooms").cast("string")}),
    }
    for part, frame in parts.items():
        frame.hint("rebalance", "snapshot").write.partitionBy("snapshot").parquet(f"{path}/{part}")
    return path


def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seen(snapshots.read_snapshots(spark, _snapshots(spark, sf_dir)))


def snapshot_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months left out for lack of a neighborhood, and how many rows they have."""
    gated = snapshots.gated_files(spark, _snapshots(spark, sf_dir))
    return gated.groupBy("date").agg(F.sum("n_rows").alias("n_rows"))


def _laid_out(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    path = scratch(spark, "dated")
    rows = roles.listings(spark, sf_dir).withColumn("date", F.trunc("date", "month"))
    snapshots.lay_out_by_date(rows, path)
    return path, rows.schema


def snapshot_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings of one month, of which only that month's folder is read."""
    path, schema = _laid_out(spark, sf_dir)
    return snapshots.read_dated(spark, path, schema).filter(F.col("date") == F.lit(MONTH)).select("listing_id", "propertyCode", "price", "date")


def snapshot_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of the months in which someone asked for a return, found by a join on dates."""
    path, schema = _laid_out(spark, sf_dir)
    late = roles.table(spark, sf_dir, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") == LARGEST_QUANTITY))
    months = late.select(F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("date")).distinct()
    read = snapshots.read_dated(spark, path, schema).join(F.broadcast(months), "date")  # months are few at any size
    return read.groupBy("date").agg(F.count(F.lit(1)).alias("n_listings"))


def listing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly JSON snapshots of one-line arrays with nested structs."""
    path = scratch(spark, "listings")
    rows = _raw_listings(spark, sf_dir)
    fields = [c for c in rows.columns if c not in ("snapshot", "listing_id")]
    arrays = nest(rows, ["snapshot"], F.struct(*fields), "listings", "listing_id", parts=4)
    arrays.select("snapshot", F.to_json("listings").alias("value")).write.partitionBy(
        "snapshot"
    ).text(path)
    return _seen(snapshots.read_listing_json(spark, path))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose addresses are quoted in the three ways markup allows, in turn."""
    html, turn = F.col("html"), F.col("page_id") % 3
    single = F.regexp_replace(html, 'href="([^"]*)"', "HREF = '$1'")
    bare = F.regexp_replace(html, 'href="([^"\\s>\']+)"', "href=$1")
    return roles.table(spark, sf_dir, "pages").withColumn(
        "html", F.when(turn == 1, single).when(turn == 2, bare).otherwise(html)
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = portal.page_links(_pages(spark, sf_dir))
    return links.select(
        "page_id",
        "pos",
        F.concat(F.lit(portal.PORTAL), F.col("href")).alias("url"),
        "text",
        portal.link_title(F.col("text")).alias("title"),
    )


def report_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last link of each wanted key, the keys being the starts of benchmark words.

    Links count only inside the first list of reports, which holds other lists; around it
    are lists of another kind, a second list of reports, and one inside a comment.
    """
    words = roles.table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("w"))
    wanted = words.select(F.left(F.lower("w"), F.lit(4)).alias("year"))
    link = F.concat(F.lit('<a href="/wrong">'), F.left("url", F.lit(60)), F.lit("</a>"))
    aside = F.concat(F.lit('<ul class="other"><li>'), link, F.lit('</li></ul><!-- <ul class="resource-list"> -->'))
    opened = F.lit('<nav><UL\n title="x" class="wide resource-list"><li>x<ul><li>y</li></ul></li>')
    again = F.concat(F.lit('</ul></nav><ul class="resource-list"><li>'), link, F.lit("</li></ul>"))
    html = F.replace(F.col("html"), F.lit("<nav><ul>"), F.concat(aside, opened))
    pages = _pages(spark, sf_dir).withColumn("html", F.replace(html, F.lit("</ul></nav>"), again))
    links = portal.page_links(pages, container=portal.REPORT_LIST)
    return portal.report_links(links, ["page_id", "pos"], wanted)


QUERIES = {
    "scan_table": scan_table,
    "sink_overwrite": sink_overwrite,
    "csv_roundtrip": csv_roundtrip,
    "csv_yearly_union": csv_yearly_union,
    "csv_dialects": csv_dialects,
    "csv_rejects": csv_rejects,
    "json_indexed": json_indexed,
    "missing_years": missing_years,
    "lookup_load": lookup_load,
    "snapshot_scan": snapshot_scan,
    "snapshot_gate": snapshot_gate,
    "snapshot_month": snapshot_month,
    "snapshot_dates": snapshot_dates,
    "listing_json": listing_json,
    "page_links": page_links,
    "report_links": report_links,
}

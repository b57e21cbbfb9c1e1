import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from areakit import schemas
from areakit.operators import kpi
from areakit.operators.income import (
    income_profile,
    most_recent,
    nest_income,
    unusable_income,
    with_most_recent,
)
from areakit.operators.latest import latest, latest_by_aggregate
from areakit.operators.listings import flat_table, in_scope, nested_table
from areakit.operators.nesting import nest
from areakit.operators.ordering import with_row_index
from areakit.operators.reconcile import lookup_pairs, reconcile, unmatched
from areakit.operators.rent import (
    RENT_KEYS,
    clean_rent,
    rent_means,
    rent_parts,
    rent_two_year,
    rent_yoy,
    unusable_prices,
)

SURFACE, MONTHLY = "Lloguer mitjà per superfície", "Lloguer mitjà mensual"


@pytest.fixture(scope="module")
def hot(spark):
    """One key has a third of the rows, many of them exact copies."""
    rng = random.Random(1)
    data = [("hot", 7)] * 200 + [("hot", i) for i in range(100)]
    data += [(f"k{rng.randrange(40)}", i) for i in range(600)]
    return spark.createDataFrame(data, "k string, v int").repartition(6)


def test_row_index_is_the_total_order(spark, hot):
    df = hot.distinct()
    got = {(r["k"], r["v"]): r["row_index"] for r in with_row_index(df, [F.col("k").desc(), "v"]).collect()}
    expected = sorted(sorted((tuple(r) for r in df.collect()), key=lambda r: r[1]), key=lambda r: r[0], reverse=True)
    assert [got[r] for r in expected] == list(range(len(expected)))


def test_row_index_over_many_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        df = spark.range(0, 50_000, 1, 7).select((F.col("id") * 7919 % 50_000).alias("v"))
        indexed = with_row_index(df, ["v"], start=1)
        assert indexed.select(F.spark_partition_id()).distinct().count() > 1
        assert indexed.filter("row_index != v + 1").count() == 0
        assert indexed.count() == 50_000
    finally:
        spark.conf.set(key, "true")


def test_row_index_of_nothing(spark):
    assert with_row_index(spark.createDataFrame([], "k string"), ["k"]).count() == 0


def test_latest_takes_the_newest_then_the_tie_breaker(spark, rows):
    data = [
        ("p", date(2020, 1, 2), 1, 100.0),
        ("p", date(2021, 2, 24), 2, 90.0),
        ("p", date(2020, 6, 1), 3, 95.0),
        ("q", date(2020, 6, 1), 5, 70.0),
        ("q", date(2020, 6, 1), 4, 71.0),
        ("r", None, 9, None),
    ]
    df = spark.createDataFrame(data, "code string, date date, id int, price double")
    expected = [("p", date(2021, 2, 24), 2, 90.0), ("q", date(2020, 6, 1), 5, 70.0), ("r", None, 9, None)]
    assert rows(latest(df, ["code"], ["date", "id"])) == expected
    assert rows(latest_by_aggregate(df, ["code"], ["date", "id"])) == expected


def test_latest_reduces_before_the_shuffle(spark, hot):
    plan = latest(hot, ["k"], ["v"])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_adaptive_execution_splits_a_hot_join_key_below_latest(spark):
    """The runtime settings let the join be split although ``latest`` has the same key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        many = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20_000).alias("k"),
            "id",
            F.rand(1).alias("v"),
        )
        few = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 25).alias("a"))
        newest = latest(many.join(few, "k"), ["k"], ["id"])
        assert len(newest.collect()) == 20_000
        assert "skew=true" in newest._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nest_parts_follow_the_element(spark, hot):
    df = hot.distinct()
    parts = {}
    for r in nest(df, ["k"], F.struct("v"), "vs", "v", parts=4).collect():
        parts.setdefault(r["k"], {})[r["part"]] = [x["v"] for x in r["vs"]]
    sizes = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    assert set(parts["hot"]) == {0, 1, 2, 3}
    for key, arrays in parts.items():
        assert all(a == sorted(a) for a in arrays.values())
        assert sum(map(len, arrays.values())) == sizes[key]
    whole = {r["k"]: [x["v"] for x in r["vs"]] for r in nest(df, ["k"], F.struct("v"), "vs", "v", 1).collect()}
    assert {k: sorted(v for a in p.values() for v in a) for k, p in parts.items()} == whole
    assert {v for a in parts["hot"].values() for v in a} == set(range(100))


def test_reconcile_and_its_complement(spark, rows):
    lookup = spark.createDataFrame(
        [("Q1", "el Raval", "El Raval"), ("Q2", "El Poble Sec", "El Poble-sec, Barcelona")],
        "_id string, ne string, ne_re string",
    )
    df = spark.createDataFrame(
        [("el Raval", 1), ("El Poble Sec", 2), ("No consta", 3), ("No consta", 4), (None, 5)],
        "neighborhood string, v int",
    )
    pairs = lookup_pairs(lookup, "ne", "ne_re")
    assert rows(reconcile(df, pairs, "neighborhood").select("neighborhood", "v")) == [
        ("El Poble-sec, Barcelona", 2),
        ("El Raval", 1),
    ]
    assert rows(unmatched(df, pairs, "neighborhood")) == [("No consta", 2), (None, 1)]


def test_most_recent(spark):
    info = "array<struct<year: int, RFD: string>>"
    cases = [
        (0, [(2014, "1"), (2016, "3"), (2015, "2")], "3"),
        (1, [(2016, "first"), (2016, "second"), (2010, "x")], "first"),
        (2, [], None),
        (3, None, None),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], f"i int, info {info}")
    got = df.orderBy("i").select(most_recent(F.col("info"), "RFD")).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]


def test_income_documents_to_profile(spark, rows):
    reports = spark.createDataFrame(
        [
            (2015, "Sants-Montjuïc", "el Poble Sec", "70.0", "40000"),
            (2016, "Sants-Montjuïc", "el Poble Sec", "76.1", "40104"),
            (2016, "Sants-Montjuïc", "la Font de la Guatlla", "84.9", "10316"),
            (2015, "No consta", "No consta", "-", "879"),
        ],
        "Any int, Nom_Districte string, Nom_Barri string, RFD string, pop string",
    )
    income = nest_income(reports)
    assert income.schema[schemas.INCOME_NAME].dataType == schemas.INCOME[schemas.INCOME_NAME].dataType
    recent = {r["name"]: (r["rfd"], r["pop"]) for r in with_most_recent(income).collect()}
    assert recent["el Poble Sec"] == (76.1, 40104.0)
    assert recent["No consta"] == (None, 879.0)
    lookup = spark.createDataFrame(
        [("Q1", "el Poble Sec", "El Poble-sec"), ("Q2", "No consta", "No consta")],
        "_id string, neighborhood string, neighborhood_reconciled string",
    )
    pairs = lookup_pairs(lookup, "neighborhood", "neighborhood_reconciled", "_id")
    assert rows(income_profile(income, pairs)) == [
        ("El Poble-sec", "Q1", "Sants-Montjuïc", 76.1, 40104.0)
    ]


def rent_frame(spark, data):
    return spark.createDataFrame(
        [(y, "D", a, "1", "7", kind, price) for a, y, kind, price in data], schemas.RENT
    )


@pytest.fixture(scope="module")
def rent(spark):
    return rent_frame(
        spark,
        [
            ("both", 2021, SURFACE, "12.50"),
            ("both", 2021, SURFACE, "12.52"),
            ("both", 2021, MONTHLY, "800"),
            ("both", 2020, SURFACE, "11.00"),
            ("both", 2020, MONTHLY, "750.5"),
            ("new", 2021, SURFACE, "9"),
            ("new", 2021, MONTHLY, "600"),
            ("old", 2020, SURFACE, "9"),
            ("old", 2020, MONTHLY, "600"),
            ("half", 2021, SURFACE, "9"),
            ("half", 2020, SURFACE, "9"),
            ("both", 2019, SURFACE, "1"),
            ("both", 2021, "Nombre de contractes", "99"),
            ("both", 2021, MONTHLY, "--"),
            ("both", 2021, MONTHLY, None),
            ("both", 2021, MONTHLY, "unknown"),
        ],
    )


def test_clean_rent(spark, rent, rows):
    kept = clean_rent(rent, 2020)
    assert kept.count() == 12
    assert kept.schema["Codi_Barri"].dataType.simpleString() == "int"
    assert rows(unusable_prices(rent)) == [("unknown", 1)]
    numeric = rent.withColumn("Preu", F.col("Preu").try_cast("double"))
    assert rows(clean_rent(numeric, 2020)) == rows(kept)


def test_rent_means_equal_the_join_of_two_aggregations(spark, rent, rows):
    clean = clean_rent(rent, 2020)
    means = rent_means(rent_parts(clean, RENT_KEYS))

    def one(word, name):
        return (
            clean.filter(F.col("Lloguer_mitja").contains(word))
            .groupBy(*RENT_KEYS)
            .agg(F.avg("Preu").alias(name))
        )

    joined = one("superfície", "s").join(one("mensual", "m"), RENT_KEYS)
    expected = [(*r[:5], float(f"{r[5]:.2f}"), float(f"{r[6]:.2f}")) for r in rows(joined)]
    assert rows(means) == expected
    assert ("both", 2021, "D", 7, 1, 12.51, 800.0) in expected


def test_two_years_and_increase(spark, rent, rows):
    means = rent_means(rent_parts(clean_rent(rent, 2020), RENT_KEYS))
    two = rent_two_year(means, 2021, 2020)
    assert [r[0] for r in rows(two)] == ["both"]
    semi = means.filter("Any = 2021").join(
        means.filter("Any = 2020").select("Nom_Barri"), "Nom_Barri", "left_semi"
    )
    assert rows(two.select(*means.columns)) == rows(semi.select(*means.columns))
    yoy = rent_yoy(means, 2021, 2020).first()
    assert yoy["monthly_increase"] == 49.5
    assert yoy["surface_increase"] == round(two.first()["surface_price"] - 11.0, 2)


@pytest.fixture(scope="module")
def listings(spark):
    data = [
        (area, f"p{i}", date(2021, 1, 1), float(price), 50.0, 2, 1, 41.0, 2.0, "sale", "flat", "bj")
        for area, prices in {"A": [100, 200, 301], "B": [50], "C": [10]}.items()
        for i, price in enumerate(prices)
    ]
    return spark.createDataFrame(
        [(r[0], f"{r[0]}{r[1]}", *r[2:]) for r in data],
        "neighborhood string, propertyCode string, date date, price double, size double, rooms int, "
        "bathrooms int, latitude double, longitude double, operation string, propertyType string, "
        "floor string",
    )


@pytest.fixture(scope="module")
def profile(spark):
    return spark.createDataFrame(
        [("A", "Q1", 1, "D", 9, 80.0, 1000.0, 12.5, 800.0), ("B", "Q2", 2, "D", 9, 120.0, 10.0, 15.0, 1000.0)],
        "neighborhood string, neighborhood_id string, neighborhood_code int, district_name string, "
        "district_code int, rfd double, pop double, surface_price double, monthly_price double",
    )


def test_flat_and_nested_tables(spark, listings, profile, rows):
    flat = flat_table(listings, profile)
    assert flat.columns == list(schemas.FLAT_COLUMNS)
    assert flat.count() == 4
    nested = nested_table(listings, profile, 1)
    assert nested.columns == list(schemas.NESTED_COLUMNS)
    assert {r["Neighborhood"]: len(r["Info Idealista"]) for r in nested.collect()} == {"A": 3, "B": 1}
    split = nested_table(listings, profile, parts=2)
    one = rows(kpi.price_by_area_nested(nested))
    assert one == [("A", 200.33, 3), ("B", 50.0, 1)]
    assert rows(kpi.price_by_area_nested(split)) == one
    assert rows(kpi.price_by_area(flat, "Neighborhood", "Price")) == one
    pairs = kpi.rent_income_pairs(nested)
    assert set(rows(pairs)) == {(800.0, 80.0), (1000.0, 120.0)}
    assert kpi.correlation(pairs, *kpi.numeric_columns(pairs)).first()[0] == 1.0


def test_split_areas_stay_one_pair(spark, profile):
    data = [("A", f"p{i}") for i in range(200)]
    cols = {f: F.lit(None).cast("double") for f in schemas.LISTING_FIELDS}
    many = spark.createDataFrame(data, "neighborhood string, propertyCode string").withColumns(cols)
    nested = nested_table(many, profile, parts=10)
    assert nested.count() > 1
    assert kpi.rent_income_pairs(nested).count() == 1


def test_mean_without_prices_is_null(spark, listings, rows):
    none = listings.filter("neighborhood = 'B'").withColumn("price", F.lit(None).cast("double"))
    assert rows(kpi.price_by_area(none)) == [("B", None, 1)]


def test_ranks(spark, listings):
    got = {r["neighborhood"]: r for r in kpi.ranked(kpi.price_by_area(listings)).collect()}
    assert [got[a]["price_rank"] for a in "CBA"] == [1, 2, 3]
    assert [got[a]["listings_rank"] for a in "ABC"] == [1, 2, 3]
    assert got["B"]["scaled_price"] == 0.05


def test_correlation_matrix_covers_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, 4.0, "b"), (3, 1.0, "c")], "x int, y double, n string")
    got = {(r["x"], r["y"]): r["correlation"] for r in kpi.correlation_matrix(df).collect()}
    assert set(got) == {(a, b) for a in "xy" for b in "xy"}
    assert got["x", "x"] == 1.0 and got["x", "y"] == got["y", "x"] == -0.327


def test_correlation_of_one_row_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert kpi.correlation(df, "x", "y").first()[0] is None


def test_scope(spark, rows):
    df = spark.createDataFrame([("Barcelona", 1), ("Girona", 2), (None, 3)], "province string, v int")
    assert rows(in_scope(df)) == [("Barcelona", 1)]


def test_finer_prices_and_odd_numbers(spark, rows):
    schema = "neighborhood string, price double"
    data = [("A", 1.004), ("A", 1.014), ("B", float("nan")), ("B", 3.0), ("C", float("inf"))]
    priced = kpi.price_by_area(spark.createDataFrame(data, schema))
    assert rows(priced) == [("A", 1.01, 2), ("B", 3.0, 2), ("C", None, 1)]


def test_rent_takes_odd_codes_and_reports_odd_prices(spark, rows):
    data = [(2021, "x", "1.0", "NaN"), (2021, "x", "1.5", "2.5"), (2021, "x", "7", "--"), (2021, "x", "8", "Infinity")]
    rent = spark.createDataFrame(data, "Any int, Nom_Barri string, Codi_Barri string, Preu string")
    assert rows(clean_rent(rent, 2020).select("Codi_Barri", "Preu")) == [(None, 2.5)]
    assert rows(unusable_prices(rent)) == [("Infinity", 1), ("NaN", 1)]
    whole = rent.filter("Preu = 'NaN'").withColumn("Preu", F.lit(1.5))
    assert rows(clean_rent(whole, 2020).select("Codi_Barri")) == [(1,)]


def test_same_name_in_two_districts_is_two_areas(spark, rows):
    data = [("A", 2021, "D", 1, 1, 5.0, 50.0), ("A", 2020, "D", 1, 1, 4.0, 40.0), ("A", 2020, "E", 2, 2, 9.0, 90.0)]
    columns = "Nom_Barri string, Any int, Nom_Districte string, Codi_Barri int, Codi_Districte int, "
    means = spark.createDataFrame(data, columns + "surface_price double, monthly_price double")
    found = rent_yoy(means, 2021, 2020)
    assert rows(found.select("Codi_Barri", "surface_increase", "monthly_increase")) == [(1, 1.0, 10.0)]


def test_unusable_income_is_reported(spark, rows):
    data = [("A ", "D", [(2015, "80", "10"), (2016, "-", "10")]), ("B", "D", [(2016, "70", "9")]), ("C", "D", [])]
    income = spark.createDataFrame(
        data, "`neigh_name ` string, district_name string, info array<struct<year:int,RFD:string,pop:string>>"
    )
    assert rows(unusable_income(income)) == [("A ", "D", "-", "10"), ("C", "D", None, None)]

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from areakit.functions.names import normalize_name, strip_quotes
from areakit.functions.numbers import (
    finish_means,
    mean_parts,
    merge_parts,
    weighted_parts,
    with_two_decimals,
)
from areakit.functions.paths import report_year, snapshot_date


def printed(value):
    return float(f"{value:.2f}") + 0.0


def test_two_decimals_is_what_printing_gives(spark):
    rng = random.Random(3)
    values = [2.675, 0.125, 0.375, 0.625, 0.875, 1.005, 280024.125, 1e13 + 0.125, 0.0, -2.675, -0.125]
    values += [rng.uniform(0.07, 10) for _ in range(500)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(500)]
    values += [round(rng.uniform(0.1, 9999), 2) + 0.005 for _ in range(1000)]
    values += [k / 8 for k in range(1, 400)]
    df = with_two_decimals(spark.createDataFrame([(v, v) for v in values], "v double, r double"), ["r"])
    wrong = [(v, r) for v, r in df.collect() if r != printed(v)]
    assert wrong == []


def test_means_of_parts_merged_in_any_split(spark):
    rng = random.Random(4)
    data = [(k, rng.randrange(5), round(rng.uniform(-50, 900000), 2)) for k in "abc" for _ in range(200)]
    data += [("d", 0, None), ("a", 1, None)]
    df = spark.createDataFrame(data, "k string, s int, v double")
    parts = df.groupBy("k", "s").agg(*mean_parts("v", "m"))
    merged = parts.groupBy("k").agg(*merge_parts("m"))
    got = {r["k"]: r["mean"] for r in finish_means(merged, {"m": "mean"}).collect()}
    for k in "abc":
        cents = [round(v * 100) for key, _, v in data if key == k and v is not None]
        assert got[k] == printed(sum(cents) / 100 / len(cents))
    assert got["d"] is None


def test_weights_count_rows(spark):
    df = spark.createDataFrame([(1.5, 2), (4.0, 1), (None, 7)], "v double, w bigint")
    merged = df.agg(*weighted_parts("v", "w", "m"))
    assert finish_means(merged, {"m": "mean"}).first()["mean"] == printed(7.0 / 3)


def test_sums_beyond_a_long_of_millionths(spark):
    """The total of millionths here does not fit a long."""
    df = spark.range(1).select(F.lit(90_000_000.01).alias("v"), F.lit(30_000_000_000).alias("w"))
    merged = df.agg(*weighted_parts("v", "w", "m"))
    assert finish_means(merged, {"m": "mean"}).first()["mean"] == 90_000_000.01


@pytest.mark.parametrize(
    "raw, plain",
    [
        ("Sants-Montjuïc", "sants montjuic"),
        ("la Nova Esquerra de l'Eixample", "la nova esquerra de l eixample"),
        ("Sarrià-Sant Gervasi", "sarria sant gervasi"),
        ("  el Camp d'en Grassot i Gràcia Nova ", "el camp d en grassot i gracia nova"),
        ("la Marina del Prat Vermell - AEI Zona Franca (1)", "la marina del prat vermell aei zona franca 1"),
        ("Vallcarca·Penitents", "vallcarca penitents"),
        ("", ""),
        (None, None),
    ],
)
def test_normalize_name(spark, raw, plain):
    df = spark.createDataFrame([(raw,)], "n string").select(normalize_name(F.col("n")))
    assert df.first()[0] == plain


def test_strip_quotes(spark):
    raw = ['"Sant Pere, Santa Caterina i la Ribera"', "el Raval", '"', '""', 'a "b"', None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, n string")
    got = [r[0] for r in df.orderBy("i").select(strip_quotes(F.col("n"))).collect()]
    assert got == ["Sant Pere, Santa Caterina i la Ribera", "el Raval", '"', "", 'a "b"', None]


def test_paths(spark):
    paths = [
        "file:/zone/idealista/2020_01_02_idealista/part-0.parquet",
        "file:/zone/opendatabcn/2014_lloguer_preu_bcn.csv",
        "file:/zone/report=2015_lloguer_preu_bcn/part-00000-1234_5.csv",
        "file:/zone/readme.txt",
        "file:/zone/2020_13_45_x/part-0.parquet",
        "file:/2024_05_06_export/2019_07_08_idealista/2018_part.parquet",
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").orderBy("i")
    got = df.select(snapshot_date(F.col("p")), report_year(F.col("p"))).collect()
    assert [r[0] for r in got] == [date(2020, 1, 2), None, None, None, None, date(2019, 7, 8)]
    assert [r[1] for r in got] == [2020, 2014, 2015, None, 2020, 2018]

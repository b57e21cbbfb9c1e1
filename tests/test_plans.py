import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from areakit import schemas
from areakit.operators import nesting
from areakit.operators.income import nest_income
from areakit.plans import rooms
from areakit.plans.exploitation import publish_indicators
from areakit.plans.integration import Landing, integrate, publish_formatted
from areakit.streaming import messages, scoring

SURFACE, MONTHLY = "Lloguer mitjà per superfície", "Lloguer mitjà mensual"
SEC, FONT = "el Poble Sec", "la Font de la Guatlla"


@pytest.fixture(scope="module")
def landing(spark):
    income = nest_income(
        spark.createDataFrame(
            [(2015, "S", SEC, "70", "1"), (2016, "S", SEC, "76.1", "40104"), (2016, "S", FONT, "84.9", "10316")],
            "Any int, Nom_Districte string, Nom_Barri string, RFD string, pop string",
        )
    )
    rent = spark.createDataFrame(
        [
            (year, "S", area, "3", code, kind, price)
            for area, code, base in ((SEC, "11", 10), (FONT, "14", 12))
            for year in (2020, 2021)
            for kind, price in ((SURFACE, f"{base}.5"), (MONTHLY, f"{base * 70}"), (MONTHLY, "--"))
        ],
        schemas.RENT,
    )
    lookup = spark.createDataFrame(
        [("Q1", SEC, "", "El Poble-sec, Barcelona"), ("Q2", FONT, "", "La Font de la Guatlla")],
        schemas.INCOME_LOOKUP,
    )
    rent_lookup = spark.createDataFrame(
        [
            ("Q1", "El Poble Sec - Parc de Montjuïc", "", "El Poble-sec, Barcelona"),
            ("Q2", "La Font de la Guatlla", "", "La Font de la Guatlla"),
        ],
        schemas.RENT_LOOKUP,
    )
    fields = ["propertyCode", "neighborhood", "date", "price", "rooms", "province"]
    rows = [
        ("1", "El Poble Sec - Parc de Montjuïc", date(2020, 1, 2), 300000.0, 3, "Barcelona"),
        ("1", "El Poble Sec - Parc de Montjuïc", date(2021, 2, 24), 280000.0, 3, "Barcelona"),
        ("2", "El Poble Sec - Parc de Montjuïc", date(2020, 1, 2), 280048.0, 2, "Barcelona"),
        ("3", "La Font de la Guatlla", date(2020, 6, 1), 422205.0, 2, "Barcelona"),
        ("4", "La Font de la Guatlla", date(2020, 6, 1), 1.0, 2, "Girona"),
        ("5", "Elsewhere", date(2020, 6, 1), 1.0, 2, "Barcelona"),
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"{f} {t}" for f, t in zip(fields, ["string", "string", "date", "double", "int", "string"])))
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schemas.LISTING.fields if f.name not in fields}
    return Landing(income, rent, raw.withColumns(absent), lookup, rent_lookup)


def test_zones_end_to_end(spark, landing, tmp_path, rows):
    flat, nested = integrate(landing, ["price"], parts=1)
    formatted, exploitation = str(tmp_path / "formatted"), str(tmp_path / "exploitation")
    assert publish_formatted(flat, nested, formatted) == {"flat_rows": 3, "nested_rows": 2, "nested_listings": 3}
    publish_indicators(spark, formatted, exploitation)
    data = spark.read.parquet(f"{formatted}/data")
    assert data.columns == list(schemas.FLAT_COLUMNS)
    assert rows(data.select("Property Code", "Neighborhood Code", "District Code", "RFD", "Monthly Price (€/month)")) == [
        ("1", 11, 3, 76.1, 700.0),
        ("2", 11, 3, 76.1, 700.0),
        ("3", 14, 3, 84.9, 840.0),
    ]
    assert rows(spark.read.parquet(f"{exploitation}/kpi1")) == [
        ("El Poble-sec, Barcelona", 280024.0, 2),
        ("La Font de la Guatlla", 422205.0, 1),
    ]
    assert rows(spark.read.parquet(f"{exploitation}/kpi2")) == [(700.0, 76.1), (840.0, 84.9)]


def test_too_few_parts_fail_early(spark, landing, monkeypatch):
    df = spark.createDataFrame([("a", str(i)) for i in range(30)] + [("b", "x")], "area string, code string")
    nesting.check_parts(df, ["area"], "code", 8, most=20)
    with pytest.raises(ValueError, match="a part of a has 30 elements"):
        nesting.check_parts(df, ["area"], "code", 1, most=20)
    nesting.check_parts(df.limit(0), ["area"], "code", 1, most=0)


@pytest.fixture(scope="module")
def flats(spark):
    return spark.range(400).select(
        F.col("id").alias("key"),
        F.concat(F.lit("Q"), (F.col("id") % 5).cast("string")).alias(rooms.CATEGORY),
        (F.col("id") % 5 * 1000.0 + F.col("id") % 3).alias(rooms.PRICE),
        (F.col("id") % 5 + 1).cast("int").alias(rooms.LABEL),
    )


@pytest.fixture(scope="module")
def model(flats):
    return rooms.fit_rooms(flats)


def test_training_subset(spark):
    df = spark.createDataFrame([("Q1", 1.0, 2, "x")], "`Neighborhood Id` string, Price double, Rooms int, o string")
    assert rooms.training_subset(df).columns == ["Neighborhood_ID", "Price", "Rooms"]


def test_split_is_stable_and_near_its_share(flats, rows):
    sided = flats.withColumn("side", rooms.split_side(F.col("key")))
    assert rows(sided) == rows(sided.repartition(7))
    train = sided.filter("side = 'train'").count()
    assert 240 < train < 320


def test_frequency_index(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert rows(rooms.frequency_index(df, "v")) == [("a", 1, 1), ("b", 1, 2), ("c", 2, 0)]


def test_model_learns_and_survives_saving(flats, model, tmp_path, rows):
    predicted = rooms.predict(model, flats)
    assert rooms.accuracy(predicted) == rooms.accuracy_table(predicted).first()["accuracy"] == 1.0
    assert predicted.filter("cast(predictedLabel as int) != Rooms").count() == 0
    path = str(tmp_path / "model")
    rooms.save_model(model, path)
    rooms.save_model(model, path)
    again = rooms.predict(rooms.load_model(path), flats)
    columns = ["key", "prediction", rooms.PREDICTED]
    assert rows(again.select(*columns)) == rows(predicted.select(*columns))
    same = rooms.predict(rooms.fit_rooms(flats), flats)
    assert rows(same.select(*columns)) == rows(predicted.select(*columns))


def test_indexing_on_all_rows_knows_held_out_values(spark, flats):
    extra = flats.limit(1).withColumn(rooms.CATEGORY, F.lit("held out"))
    everything = flats.unionByName(extra)
    sizes = [
        m.stages[4].numFeatures for m in (rooms.fit_rooms(flats), rooms.fit_rooms(flats, everything))
    ]
    assert sizes == [6, 7]


def test_unseen_area_has_no_slot(flats, model):
    from pyspark.ml.functions import vector_to_array

    unseen = flats.limit(1).withColumn(rooms.CATEGORY, F.lit("unseen"))
    one_hot = rooms.predict(model, unseen).select(vector_to_array(rooms.CATEGORY_ONE_HOT)).first()[0]
    assert one_hot == [0.0] * 5


def test_summary(spark, model):
    stages = rooms.model_summary(spark, model).collect()
    assert [s["kind"] for s in stages][-2:] == ["RandomForestClassificationModel", "IndexToString"]
    assert (stages[4]["num_trees"], stages[4]["num_features"], stages[4]["num_classes"]) == (3, 6, 6)


LINES = ["a,Q1,1000.0", "a,Q2", "a,Q3,x", "", "a,unseen,2000", "a,Q4,4001.0,more", ",Q0,0"]


def test_parse_and_reject(spark, rows):
    df = spark.createDataFrame([(v,) for v in [*LINES, None]], "value string")
    parsed = messages.parse_messages(df)
    assert rows(messages.accepted(parsed)) == [("Q0", 0.0), ("Q1", 1000.0), ("Q4", 4001.0), ("unseen", 2000.0)]
    assert rows(messages.rejected(parsed)) == [
        ("", "no area"), ("a,Q2", "no price"), ("a,Q3,x", "price is no number"), (None, "no area"),
    ]


def test_stream_scores_like_batch_and_restarts(spark, model, tmp_path, rows):
    source, sink, log = (tmp_path / n for n in ("in", "out", "log"))
    source.mkdir()

    def run():
        stream = messages.message_stream(spark, "text", str(source))
        query = messages.append_to(
            scoring.score_messages(stream, model), str(log), path=str(sink), name="scoring"
        )
        messages.run_for(query, 60)

    (source / "a.txt").write_text("\n".join(LINES))
    run()
    run()
    (source / "b.txt").write_text("a,Q2,2001.0\nbad\n")
    run()
    batch = spark.createDataFrame([(v,) for v in [*LINES, "a,Q2,2001.0", "bad"]], "value string")
    expected = rows(scoring.score_messages(batch, model))
    assert len(expected) == 5
    assert rows(spark.read.parquet(str(sink))) == expected


def test_stream_keeps_rejects(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.txt").write_text("\n".join(LINES))
    stream = messages.message_stream(spark, "text", str(source))
    routed = messages.routed(messages.parse_messages(stream))
    messages.run_for(messages.append_to(routed, str(tmp_path / "log"), path=sink, partition_by="route"), 60)
    counts = {r["route"]: r["count"] for r in spark.read.parquet(sink).groupBy("route").count().collect()}
    assert counts == {"accepted": 4, "rejected": 3}


def test_periodic_query_is_stopped_in_time(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("a,Q1,1")
    parsed = messages.accepted(messages.parse_messages(messages.message_stream(spark, "text", str(source))))
    query = messages.append_to(parsed, str(tmp_path / "log"), path=str(tmp_path / "out"), every="1 second")
    messages.run_for(query, 5)
    assert not query.isActive
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_other_sinks(spark, tmp_path, rows):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("a,Q1,1\na,Q2,2\n")

    def run(fmt, **kwargs):
        stream = messages.message_stream(spark, "text", str(source))
        parsed = messages.accepted(messages.parse_messages(stream))
        messages.run_for(messages.append_to(parsed, str(tmp_path / fmt), fmt, **kwargs), 60)

    run("console")
    run("memory", name="scored")
    assert rows(spark.table("scored")) == [("Q1", 1.0), ("Q2", 2.0)]


def test_train_from_the_flat_table_then_score_a_stream(spark, flats, tmp_path):
    flat = flats.select(
        F.col("key").cast("string").alias("Property Code"),
        F.col(rooms.CATEGORY).alias("Neighborhood Id"),
        "Price",
        "Rooms",
    )
    fitted, predictions = rooms.train_rooms(flat)
    assert 0 < predictions.count() < 400
    assert rooms.accuracy(predictions) == 1.0
    rooms.save_model(fitted, str(tmp_path / "model"))
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.txt").write_text("x,Q3,3001\nbad\n")
    stream = messages.message_stream(spark, "text", str(source))
    scoring.score_stream(
        stream, str(tmp_path / "model"), str(tmp_path / "log"), "parquet", out, seconds=60
    )
    assert [tuple(r)[::3] for r in spark.read.parquet(out).collect()] == [("Q3", "4")]


def test_messages_that_arrive_while_a_run_lasts_are_scored(spark, tmp_path):
    from areakit.streaming.messages import accepted, append_to, message_stream, parse_messages, run_for

    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.txt").write_text("x,1,5.0\n")
    parsed = accepted(parse_messages(message_stream(spark, "text", str(inbox))))
    query = append_to(parsed, str(tmp_path / "log"), path=out, once=False)
    threading.Timer(4, lambda: (inbox / "b.txt").write_text("x,2,6.0\nx, ,7.0\nx,3,NaN\n")).start()
    run_for(query, 25)
    found = spark.read.schema(parsed.schema).parquet(out).collect()
    assert sorted((r[0], r[1]) for r in found) == [("1", 5.0), ("2", 6.0)]

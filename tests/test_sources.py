import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit import schemas
from areakit.plans.landing import outstanding_years, persist_reports
from areakit.session import scratch, shared_dir
from areakit.sources import lookups, portal, reports, snapshots
from areakit.sources.tables import overwrite_partitions, overwrite_table, read_table


@pytest.fixture
def folder(tmp_path):
    return tmp_path / "zone"


def put(path, content, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode(encoding))


def test_scratch_is_below_the_named_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(shared_dir(spark))
    assert scratch(spark, "x") != scratch(spark, "x")


def test_overwrite_replaces(spark, folder, rows):
    for fmt in ("parquet", "json", "orc"):
        path = str(folder / fmt)
        overwrite_table(spark.range(5), path, fmt)
        overwrite_table(spark.range(2), path, fmt)
        assert rows(read_table(spark, path, fmt, spark.range(0).schema)) == [(0,), (1,)]


def test_a_failed_overwrite_leaves_the_old_table(spark, folder, rows):
    path = str(folder / "table")
    overwrite_table(spark.range(5), path)
    fails = F.when(F.col("id") == 90, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long")
    with pytest.raises(Exception, match="broken"):
        overwrite_table(spark.range(0, 100, 1, 4).select(fails.alias("id")), path)
    assert rows(read_table(spark, path)) == [(i,) for i in range(5)]
    assert [p.name for p in folder.iterdir() if not p.name.startswith(".")] == ["table"]
    overwrite_table(read_table(spark, path).filter("id > 2"), path)  # reads what it replaces
    assert rows(read_table(spark, path)) == [(3,), (4,)]


def test_overwriting_some_partitions(spark, folder, rows):
    path = str(folder / "table")
    rows_of = lambda *r: spark.createDataFrame(r, "v int, day string")
    overwrite_table(rows_of((1, "a"), (2, "b"), (3, "b")), path, partition_by=["day"])
    overwrite_partitions(rows_of((4, "b"), (5, "c")), path, ["day"])
    assert rows(read_table(spark, path, schema=rows_of().schema)) == [(1, "a"), (4, "b"), (5, "c")]


def listing(spark, *codes, **columns):
    df = spark.createDataFrame([(c,) for c in codes], "propertyCode string")
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


def test_snapshots(spark, folder, rows):
    """Two parts on one day, a day without the column, an empty one, and other files."""
    listing(spark, "a", "b", neighborhood="el Raval", price=1.5).withColumn(
        "rooms", F.lit(2).cast("bigint")
    ).repartition(2).write.parquet(
        str(folder / "2020_01_02_idealista")
    )
    listing(spark, "c", price=2.5).write.parquet(str(folder / "2020_06_01_idealista"))
    listing(spark, "d", rooms=3).withColumn(
        "neighborhood", F.lit(None).cast("string")
    ).withColumn("rooms", F.col("rooms").cast("bigint")).write.parquet(str(folder / "2020_06_22_idealista"))
    listing(spark, neighborhood="x").write.parquet(str(folder / "2020_11_11_idealista"))
    put(folder / "2021_02_24_idealista" / "note.txt", "no listing")
    got = snapshots.read_snapshots(spark, str(folder))
    assert got.drop("date").schema == schemas.LISTING
    assert rows(got.select("date", "propertyCode", "neighborhood", "price", "rooms")) == [
        (date(2020, 1, 2), "a", "el Raval", 1.5, 2),
        (date(2020, 1, 2), "b", "el Raval", 1.5, 2),
    ]


def test_snapshots_of_different_types(spark, folder, rows):
    """One file per type of price and rooms; struct fields come and go; bad texts are null."""
    base = dict(neighborhood="n")
    typed = F.struct(F.lit("flat").alias("typology"))
    both = F.struct(F.lit("loft").alias("subTypology"), F.lit("house").alias("typology"), F.lit(1).alias("other"))
    made = {
        "2020_01_02": listing(spark, "a", price=1.5, rooms=2, **base).withColumn("detailedType", typed),
        "2020_01_03": listing(spark, "b", price=7, **base).withColumn("price", F.col("price").cast("long")),
        "2020_01_04": listing(spark, "c", price="2.5", rooms="x", **base).withColumn("detailedType", both),
        "2020_01_05": listing(spark, "d", price=3.5, **base).withColumn("rooms", F.lit(4).cast("bigint")),
        "2020_01_06": listing(spark, "e", price=3.5),
        "2020_01_07": listing(spark, "f", price=F.lit(4.0).cast("float"), **base).withColumn("detailedType", F.lit("text")),
    }
    for day, df in made.items():
        df.coalesce(1).write.parquet(str(folder / f"{day}_idealista"))
    got = snapshots.read_snapshots(spark, str(folder))
    assert got.drop("date").schema == schemas.LISTING
    wanted = ["propertyCode", "price", "rooms", "detailedType.typology", "detailedType.subTypology"]
    assert rows(got.select(*wanted)) == [
        ("a", 1.5, 2, "flat", None),
        ("b", 7.0, None, None, None),
        ("c", 2.5, None, "house", "loft"),
        ("d", 3.5, 4, None, None),
        ("f", 4.0, None, None, None),
    ]
    assert rows(snapshots.gated_files(spark, str(folder)).select("date", "n_rows")) == [(date(2020, 1, 6), 1)]
    groups = snapshots.schema_groups(spark, str(folder))
    assert 4 <= len(groups) <= 6 and sum(len(files) for files, _ in groups) == 6


def test_snapshots_of_one_type_are_one_scan(spark, folder):
    for day in range(1, 6):
        listing(spark, "a", neighborhood="n", price=float(day)).write.parquet(str(folder / f"2020_01_0{day}_idealista"))
    assert snapshots.schema_groups(spark, str(folder))[0][0] == [str(folder)]
    assert snapshots.read_snapshots(spark, str(folder))._jdf.queryExecution().toString().count("FileScan parquet") == 1


def test_no_snapshots_at_all(spark, folder):
    put(folder / "note.txt", "nothing")
    got = snapshots.read_snapshots(spark, str(folder))
    assert got.count() == 0 and "price" in got.columns


def test_layout_by_date_prunes(spark, folder, rows):
    """A filter on dates, and a join with dates, read only their folders."""
    df = listing(spark, "a", "b", neighborhood="n").withColumn("date", F.lit(date(2020, 1, 2)))
    other = listing(spark, "c", neighborhood="n").withColumn("date", F.lit(date(2020, 1, 3)))
    path = str(folder / "laid")
    snapshots.lay_out_by_date(df.unionByName(other), path)
    schema = spark.createDataFrame([], "propertyCode string, neighborhood string").schema
    read = snapshots.read_dated(spark, path, schema)
    one = read.filter(F.col("date") == date(2020, 1, 3))
    assert rows(one) == [("c", "n", date(2020, 1, 3))]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    put(folder / "dates" / "d.csv", "2020-01-02,x\n2020-01-03,y\n")
    wanted = spark.read.schema("date date, v string").csv(str(folder / "dates")).filter("v = 'y'").select("date")
    joined = read.join(F.broadcast(wanted), "date")
    assert rows(joined.select("propertyCode")) == [("c",)]
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()


def test_snapshots_read_from_the_layout_by_date(spark, folder, rows):
    dated = listing(spark, "a", neighborhood="n").withColumn("date", F.lit(date(2020, 1, 2)))
    snapshots.lay_out_by_date(dated, str(folder))
    assert rows(snapshots.read_snapshots(spark, str(folder)).select("propertyCode", "date")) == [("a", date(2020, 1, 2))]


def test_arriving_snapshots_are_read_once(spark, folder, tmp_path, rows):
    from areakit.streaming.messages import append_to, run_for

    folder.mkdir()
    sink = str(tmp_path / "out")
    for day, code in (("02", "a"), ("03", "b")):
        listing(spark, code, neighborhood="n").write.parquet(str(folder / f"2020_01_{day}_idealista"))
        run_for(append_to(snapshots.arriving_snapshots(spark, str(folder)), str(tmp_path / "log"), path=sink), 60)
    listing(spark, "c").write.parquet(str(folder / "2020_01_04_idealista"))
    run_for(append_to(snapshots.arriving_snapshots(spark, str(folder)), str(tmp_path / "log"), path=sink), 60)
    got = spark.read.parquet(sink).select("propertyCode", "date")
    assert rows(got) == [("a", date(2020, 1, 2)), ("b", date(2020, 1, 3))]


ONE = '{"propertyCode": "%s", "price": 355000.0, "neighborhood": "El Poble Sec", "rooms": 4, %s}'
NESTED = '"detailedType": {"typology": "flat"}, "parkingSpace": {"hasParkingSpace": true, "parkingSpacePrice": 9.5}'


def test_listing_json_arrays(spark, folder, rows):
    first, second = ONE % ("92443531", NESTED), ONE % ("2", '"hasLift": true')
    put(folder / "2020_01_02_idealista.json", f"[{first}, {second}]")
    put(folder / "2020_11_11_idealista.json", "[]")
    expected = [
        (date(2020, 1, 2), "2", None, None, True),
        (date(2020, 1, 2), "92443531", "flat", 9.5, None),
    ]
    wanted = ["date", "propertyCode", "detailedType.typology", "parkingSpace.parkingSpacePrice", "hasLift"]
    for multi_line in (False, True):
        got = snapshots.read_listing_json(spark, str(folder), multi_line=multi_line)
        assert rows(got.select(*wanted)) == expected
    put(folder / "2020_01_02_idealista.json", f"[\n{first},\n{second}\n]")
    got = snapshots.read_listing_json(spark, str(folder), multi_line=True)
    assert rows(got.select(*wanted)) == expected


def test_lookup_lines(spark, folder, rows):
    put(
        folder / "lookup.json",
        '{"_id":"Q1","ne":"Horta","ne_n":"horta","ne_re":"\\"Horta, Barcelona\\""}\n'
        '{"_id":"Q2","ne":"Les Roquetes","ne_n":"les roquetes","ne_re":"Les Roquetes"}\n',
    )
    lookup = lookups.read_lookup(spark, str(folder), schemas.RENT_LOOKUP)
    assert rows(lookup.select("ne", "ne_re")) == [
        ("Horta", "Horta, Barcelona"),
        ("Les Roquetes", "Les Roquetes"),
    ]
    assert lookups.repeated_names(lookup, "ne").count() == 0
    assert rows(lookups.repeated_names(lookup.union(lookup), "ne")) == [("Horta", 2), ("Les Roquetes", 2)]


def test_extended_lookup_to_both_lookups(spark, folder, rows):
    header = ",".join(schemas.EXTENDED_LOOKUP.names)
    put(
        folder / "extended.csv",
        f"{header}\n"
        'Horta Guinardó,Horta,Horta-Guinardó,horta guinardo,Q9,"Horta, Barcelona",horta,Q2\n'
        "Horta Guinardó,El Baix Guinardó,Horta-Guinardó,horta guinardo,Q9,El Baix Guinardó,el baix guinardo,Q1\n",
    )
    extended = lookups.read_extended_lookup(spark, str(folder))
    assert rows(lookups.district_lookup(extended)) == [
        ("Q9", "Horta Guinardó", "horta guinardo", "Horta-Guinardó", ["Q1", "Q2"], 0)
    ]
    assert rows(lookups.neighborhood_lookup(extended))[1] == ("Q2", "Horta", "horta", "Horta, Barcelona")


COLUMNS = ["Any", "Nom_Barri", "Població", "Preu"]


def test_reports_of_all_dialects(spark, folder, rows):
    put(folder / "2014_x_bcn.csv", "Any,Nom_Barri,Població\n2014,\"Sants, part\",10\n2014,Gràcia,11\n")
    put(folder / "2015_x_bcn.csv", "Any,Nom_Barri,Població\n2015,Montjuïc,12\n", "iso-8859-1")
    put(folder / "2016_x_bcn.csv", "Preu;Any;Nom_Barri\n1,5;2016;Vallès\n\"2\";2016;\"a;b \"\"c\"\"\"\n", "iso-8859-1")
    put(folder / "2017_x_bcn.csv", "﻿\"Any\",\"Preu\",\"Altres\"\r\n2017,3,z\r\n2017,,\r\n")
    put(folder / "other.csv", "a,b\n1,2\n")
    got = reports.read_reports(spark, str(folder), COLUMNS)
    assert got.columns == ["file", *COLUMNS]
    assert rows(got.drop("file")) == sorted(
        [
            ("2014", "Sants, part", "10", None),
            ("2014", "Gràcia", "11", None),
            ("2015", "Montjuïc", "12", None),
            ("2016", "Vallès", None, "1,5"),
            ("2016", 'a;b "c"', None, "2"),
            ("2017", None, None, "3"),
            ("2017", None, None, None),
        ],
        key=repr,
    )


def test_only_the_first_line_is_a_header(spark, folder, rows):
    put(folder / "a.csv", "Any,Preu\n2014,1\nAny,Preu\n2014,Any Preu\n")
    put(folder / "b.csv", "ANY,PREU\nx,Any Preu\nAny,Preu\n1,2\n")
    put(folder / "c.csv", 'Any,Preu\n2015,"el\nRaval"\n2015,3\n')
    put(folder / "d.csv", "Any,Preu\n2016,\u00c3\u00a9\n2016,\u00ff\n", "iso-8859-1")
    got = reports.read_reports(spark, str(folder), ["Any", "Preu"])
    expected = [("2014", "1"), ("Any", "Preu"), ("2014", "Any Preu"), ("2016", "\u00c3\u00a9"), ("2016", "\u00ff")]
    expected += [("2015", "el\nRaval"), ("2015", "3")]
    assert rows(got.drop("file")) == sorted(expected)
    assert reports.spoilt_lines(spark, str(folder)).count() == 0


def spoilt(spark, folder):
    return {r.file.rsplit("/", 1)[1]: r.n_lines for r in reports.spoilt_lines(spark, str(folder)).collect()}


def test_records_of_several_lines_and_stray_marks(spark, folder, rows):
    """A stray mark loses the lines it spoils, and nothing else of the file."""
    put(folder / "a.csv", 'Any,Preu,Nom\n2014,"el\nRaval, ""dalt""\n",x\n2014,3" pipe,"y"\n2014,5"",z\n')
    put(folder / "b.csv", 'Any,Preu,Nom\n2015,"3 pipe,x\n2015,4,y\n2015,"a;b",z\n2015,"c\nd",w\n')
    put(folder / "c.csv", '"Any";"Preu\n(€)";Nom\r\n2016;"x\r\ny";a\r\n2016;"6;b\r\n2016;7;c\r\n')
    put(folder / "d.csv", 'Any,Preu,Nom\n2017,"8,a\n' + "2017,9,b\n" * 450 + '2017,"10,c\n2017,11,d\n')
    got = reports.read_reports(spark, str(folder), ["Any", "Preu", "Preu\n(€)", "Nom"])
    expected = [
        ("2014", 'el\nRaval, "dalt"\n', None, "x"),
        ("2014", '3" pipe', None, "y"),
        ("2014", '5""', None, "z"),
        ("2015", "4", None, "y"),
        ("2015", "a;b", None, "z"),
        ("2015", "c\nd", None, "w"),
        ("2016", None, "x\ny", "a"),
        ("2016", None, "7", "c"),
        *[("2017", "9", None, "b")] * 450,
        ("2017", "11", None, "d"),
    ]
    assert rows(got.drop("file")) == sorted(expected, key=repr)
    assert spoilt(spark, folder) == {"b.csv": 1, "c.csv": 1, "d.csv": 2}


def plain_records(text, separator):
    """Record ends by reading character by character."""
    out, start, inside, field_start, at = [], 0, False, True, 0
    while at < len(text):
        c = text[at]
        if inside:
            if c == '"' and text[at + 1 : at + 2] == '"':
                at += 1
            elif c == '"':
                inside = False
        elif c == '"' and field_start:
            inside = True
        elif c == "\n":
            out.append(text[start:at])
            start = at + 1
        field_start = not inside and c in (separator, "\n")
        at += 1
    return out if not inside and start == len(text) else None


def test_scan_over_blocks_equals_reading_in_order(spark, folder):
    """Files cut into many blocks: the records are those that one pass would find."""
    draw = random.Random(6)
    pieces = ["ab", "1", '"x y"', '"l\nm"', '"a ""q"" b"', '"\n\n"', 'in"ch', '"p,\n""\nq"', ""]
    expected = []
    for number in range(3):
        text = "c0,c1,c2\n" + "".join(",".join(draw.choices(pieces, k=3)) + "\n" for _ in range(400))
        put(folder / f"{number}.csv", text)
        found = plain_records(text, ",")
        assert found and len(found) == 401
        expected += found
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = reports.Reports(spark, str(folder))
        assert read.records.select("file", "block").distinct().count() > 20
        assert sorted(r["line"] for r in read.records.collect()) == sorted(expected)
        assert read.spoilt.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_each_line_is_parsed_once_per_separator(spark, folder, rows):
    names = [f"c{i}" for i in range(24)]
    put(folder / "a.csv", ",".join(names) + "\n" + ",".join("x" * 24) + "\n")
    assert rows(reports.read_reports(spark, str(folder), names).drop("file")) == [("x",) * 24]
    few = folder / "few"
    put(few / "a.csv", "c0,c1,c2\nx,y,z\n")
    plan = reports.read_reports(spark, str(few), names[:3])._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_csv(") == 2


def test_reports_written_and_indexed(spark, folder, rows):
    df = spark.createDataFrame([(2015, "b", 1), (2014, "ú;\"", 2), (2015, "a", 3)], "Any int, n string, v int")
    reports.write_reports(df, str(folder / "csv"), "Any", "accidents")
    names = sorted(p.name for p in (folder / "csv").glob("report=*"))
    assert names == ["report=2014_accidents_bcn", "report=2015_accidents_bcn"]
    read = reports.read_reports(spark, str(folder / "csv"), ["Any", "n", "v"])
    assert rows(read.drop("file")) == sorted([("2015", "b", "1"), ("2014", 'ú;"', "2"), ("2015", "a", "3")])
    reports.write_indexed_json(df, str(folder / "json"), ["Any", "n"])
    indexed = reports.read_indexed_json(spark, str(folder / "json"), df.schema)
    assert rows(indexed) == sorted([(2014, 'ú;"', 2, 0), (2015, "a", 3, 1), (2015, "b", 1, 2)])
    lines = spark.read.text(str(folder / "json")).collect()
    assert json.loads(lines[0][0])["0"] == {"Any": 2014, "n": 'ú;"', "v": 2}


def test_one_object_for_a_whole_file(spark, folder, rows):
    """The form in which a topic arrives: any layout, keys in any order, nulls."""
    put(folder / "a.json", '{\n "1": {"n": null, "v": 4},\n "0": {"n": "é"}\n}')
    got = reports.read_indexed_json(spark, str(folder), spark.createDataFrame([], "n string, v int").schema, whole=True)
    assert rows(got) == [("é", None, 0), (None, 4, 1)]


def test_objects_hold_so_many_rows_each(spark, folder):
    df = spark.range(2_501).select(F.col("id").alias("n"), F.lit(None).cast("string").alias("none"))
    reports.write_indexed_json(df, str(folder), [F.col("n").desc()])
    sizes = sorted(len(json.loads(r[0])) for r in spark.read.text(str(folder)).collect())
    assert sizes == [501, 1_000, 1_000]
    got = reports.read_indexed_json(spark, str(folder), df.schema)
    assert got.filter("row_index <> 2500 - n").count() == 0 and got.distinct().count() == 2_501


def test_missing_years(spark, folder, rows):
    for name in ("2014_lloguer_preu_bcn.csv", "2016_lloguer_preu_bcn.csv", "readme.md"):
        put(folder / name, "x\n")
    files = portal.present_files(spark, str(folder))
    assert rows(portal.missing_topic_years(files, "lloguer_preu", 2018)) == [(2015,), (2017,)]
    assert rows(portal.missing_topic_years(files, "accidents", 2018)) == [(2017,)]


HTML = """<ul class="resource-list">
<li><a class="heading" href=" /d/2015 ">2015_lloguer_preu CSV</a></li>
<li><A title="x" class="big heading" HREF="/d/2016"><b>2016_Lloguer</b>CSV</A></li>
<li><a class="heading" href="/d/2016x">2016_lloguer_xml.gz</a></li>
<li><a class="heading" href="/d/2016b">2016_lloguer_b.7z</a></li>
<li><a class="heading" name="none">2017_lloguer CSV</a></li>
<li><a class="other" href="/d/2018">2018_lloguer CSV</a></li>
<li><article data-href="/no">no</article></li></ul>"""


def test_links(spark, rows):
    pages = spark.createDataFrame([(1, HTML)], "page_id int, html string")
    links = portal.page_links(pages)
    assert [r[2] for r in rows(links)] == ["/d/2015", "/d/2016", "/d/2016x", "/d/2016b", "/d/2018"]
    headings = portal.page_links(pages, css_class="heading")
    assert headings.count() == 4
    got = rows(portal.report_links(headings, ["pos"], base="http://p"))
    assert got == [("2015", "http://p/d/2015"), ("2016", "http://p/d/2016b")]
    wanted = spark.createDataFrame([("2015",), ("2015",)], "year string")
    assert rows(portal.report_links(headings, ["pos"], wanted, "http://p")) == got[:1]


SCOPED = """<a href="/before">a</a><!-- <ul class="resource-list"><a href="/comment">c</a></ul> -->
<script>var x = '<ul class="resource-list">';</script>
<ul><li><a href="/other">o</a></li></ul>
<UL class='wide resource-list'><li><a href="/1">1</a><ul><li><a class=heading href="/2">2</a></li></ul></li>
<ul class="resource-list"><li><a href="/3">3</a></li></ul><li><a href="/4">4</a></li></ul>
<ul class="resource-list-item"><a href="/5">5</a></ul>
<ul class="resource-list"><a href="/6">6</a></ul></ul><a href="/after">z</a>
<div class="resource-actions actions big"><div><a class="resource-type-None" href="/7">7</a></div>
<a class="resource-type-None" href="/8">8</a></div><div class="actions"><a href="/9">9</a></div>"""


def test_links_inside_their_container(spark, rows):
    """Nested elements do not end a container, and look-alikes do not begin one."""
    unclosed = '<ul class="resource-list"><li><a href="/u">u</a>'
    pages = spark.createDataFrame([(1, SCOPED), (2, "<p>none</p>"), (3, None), (4, unclosed)], "page_id int, html string")

    def found(container, **options):
        return [(r["page_id"], r["href"]) for r in portal.page_links(pages, container=container, **options).orderBy("page_id", "pos").collect()]

    assert found(portal.REPORT_LIST) == [(1, "/1"), (1, "/2"), (1, "/3"), (1, "/4"), (4, "/u")]
    every = portal.Container("ul", "resource-list", first_only=False)
    assert found(every) == [(1, "/1"), (1, "/2"), (1, "/3"), (1, "/4"), (1, "/6"), (4, "/u")]
    assert found(portal.REPORT_LIST, css_class="heading") == [(1, "/2")]
    assert found(portal.DOWNLOADS, css_class="resource-type-None") == [(1, "/7"), (1, "/8")]


def test_titles_ending_in_xml_are_left_out(spark):
    pages = spark.createDataFrame([(1, '<a href="/x">2016_lloguer_xml   </a><a href="/y">2016_lxmlCSV</a>')], "page_id int, html string")
    links = portal.page_links(pages)
    assert [r["year"] for r in portal.report_links(links, ["pos"]).collect()] == ["2016"]


def columns(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def test_persisted_reports_keep_line_order(spark, folder, rows):
    put(folder / "in" / "2015_x_bcn.csv", "Any;Preu\n2015;3\n2015;3\n2015;1\n")
    put(folder / "in" / "2014_x_bcn.csv", "Any,Nom\n2014,é\n2014,b\n", "iso-8859-1")
    put(folder / "in" / "2016_x_bcn.csv", "Any,Nom\n")
    put(folder / "in" / "2017_x_bcn.csv", "")
    assert reports.report_columns(spark, str(folder / "in")) == ["Any", "Nom", "Preu"]
    persist_reports(spark, str(folder / "in"), str(folder / "out"))
    got = reports.read_indexed_json(spark, str(folder / "out"), columns("Any", "Nom", "Preu"))
    got = got.select("row_index", "Any", "Nom", "Preu")
    assert rows(got) == [
        (0, "2014", "é", None),
        (1, "2014", "b", None),
        (2, "2015", None, "3"),
        (3, "2015", None, "3"),
        (4, "2015", None, "1"),
    ]
    assert rows(outstanding_years(spark, str(folder / "in"), "lloguer_preu", 2020)) == [
        (2017,), (2018,), (2019,)
    ]


def test_lines_of_a_file_read_in_several_blocks(spark, folder, rows):
    text = "Any,n\n" + "".join(f"2014,{i}\n" for i in range(20000))
    put(folder / "in" / "2014_x_bcn.csv", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = reports.read_reports(spark, str(folder / "in"), ["n"], positions=True)
        assert read.select("block").distinct().count() > 5
        persist_reports(spark, str(folder / "in"), str(folder / "out"), ["n"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = reports.read_indexed_json(spark, str(folder / "out"), columns("n"))
    assert got.count() == 20000
    assert got.filter("row_index != cast(n as bigint)").count() == 0

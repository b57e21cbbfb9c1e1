"""Yearly CSV reports in several dialects, and their sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areakit.functions.paths import FILE_PATH
from areakit.operators.ordering import with_row_index
from areakit.session import settle
from areakit.sources.records import join_records, opens

LEGACY_ENCODING = "ISO-8859-1"
SEPARATORS = (",", ";")
OBJECT_ROWS = 1_000  # in one JSON object
BYTE_ORDER_MARK = "\ufeff"


def decoded(line: Column, legacy: Column) -> Column:
    """A line as text: UTF-8, or the legacy encoding for lines of such a file."""
    return F.when(legacy, F.decode(line.cast("binary"), LEGACY_ENCODING)).otherwise(line)


def with_fields(df: DataFrame, line: str, separator: str, width: int, name: str) -> DataFrame:
    """Add the CSV fields of column ``line`` as an array of ``width`` strings.

    Null beyond the last field. Each line is parsed once, by the branch of its separator:
    the lambda binds the parsed struct, so reading its fields does not repeat the parse.
    """
    names = [f"c{i}" for i in range(width)]
    ddl = ", ".join(f"{n} string" for n in names)
    comma, semicolon = (
        F.from_csv(F.col(line), F.lit(ddl), {"sep": s, "escape": '"'}) for s in SEPARATORS
    )
    parsed = F.when(F.col(separator) == SEPARATORS[1], semicolon).otherwise(comma)
    fields = F.transform(F.array(parsed), lambda row: F.array(*(row[n] for n in names)))
    return df.withColumn(name, F.get(fields, F.lit(0)))


def _occurrences(text: Column, mark: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def read_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Every line of the CSV files below a folder, not yet decoded, with the file it is in."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(directory)
        .select(
            F.col(FILE_PATH).alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").alias("line"),
        )
    )


def with_position(lines: DataFrame) -> DataFrame:
    """Add ``place``: with ``file`` and ``block``, a line's place in its file.

    One task reads a block in order, so the running number of its rows orders them.
    """
    return lines.withColumn("place", F.monotonically_increasing_id())


def probe_headers(lines: DataFrame) -> DataFrame:
    """What each file is like, one row per file that has lines.

    ``header_line``, ``header_block`` and ``header_place``: its first line. ``separator``: the one
    more frequent in that line, the comma in doubt. ``legacy``: some line is no UTF-8.
    ``several``: some line leaves a quoted field open, so that its records have to be put
    together. One row per file and task is left before anything is shuffled.
    """
    first = F.min(F.struct("block", "place", "line"))
    lined = with_position(lines)
    probed = (
        lined.groupBy("file")
        .agg(
            first.alias("first"),
            F.max(~F.is_valid_utf8("line")).alias("legacy"),
            *(F.max(opens(F.col("line"), s)).alias(f"opens{i}") for i, s in enumerate(SEPARATORS)),
        )
        .select(
            "file",
            "legacy",
            "opens0",
            "opens1",
            decoded(F.col("first.line"), F.col("legacy")).alias("header_line"),
            F.col("first.block").alias("header_block"),
            F.col("first.place").alias("header_place"),
        )
    )
    comma, semicolon = (_occurrences(F.col("header_line"), s) for s in SEPARATORS)
    other = semicolon > comma
    return probed.select(
        "file",
        "legacy",
        F.when(other, F.col("opens1")).otherwise(F.col("opens0")).alias("several"),
        "header_line",
        "header_block",
        "header_place",
        F.when(other, SEPARATORS[1]).otherwise(SEPARATORS[0]).alias("separator"),
        F.greatest(comma, semicolon).alias("marks"),
    )


def _width(headers: DataFrame) -> int:
    return (headers.agg(F.max("marks").alias("marks")).first()["marks"] or 0) + 1


def _with_names(headers: DataFrame, width: int) -> DataFrame:
    bare = headers.withColumn("_header", F.ltrim("header_line", F.lit(BYTE_ORDER_MARK)))
    fields = with_fields(bare, "_header", "separator", width, "_fields")
    return fields.withColumn("_names", F.transform("_fields", lambda n: F.trim(n)))


def _decoded_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Decoded lines with their places, their file's separator, and whether records need joining."""
    of_file = headers.select("file", "separator", "legacy", "several")
    joined = with_position(lines).join(of_file, "file")
    return joined.withColumn("line", decoded(F.col("line"), F.col("legacy"))).drop("legacy")


class Reports:
    """The records of all CSV reports below a folder.

    ``headers`` has a row per file; ``records`` the text of every record, the header's included,
    with its place; ``spoilt`` the lines that stray quotes made unreadable. Only the lines of
    files in which a line leaves a quote open are put together, all others pass by.
    """

    def __init__(self, spark: SparkSession, directory: str):
        lines = read_lines(spark, directory)
        headers = settle(probe_headers(lines))
        text = _decoded_lines(lines, headers)
        keys = ["file", "block", "place", "line", "separator"]
        self.records = text.filter(~F.col("several")).select(*keys)
        self.headers, self.spoilt = headers, self.records.limit(0).drop("separator")
        several = headers.filter("several")
        if not several.isEmpty():
            joined, self.spoilt = join_records(text.filter("several").select(*keys), SEPARATORS)
            joined = settle(joined)
            # A header, too, may go over several lines.
            first = joined.groupBy("file").agg(F.min(F.struct("block", "place", "line")).alias("first"))
            marks = F.greatest(*(_occurrences(F.col("first.line"), s) for s in SEPARATORS))
            found = several.drop("header_line", "header_block", "header_place", "marks").join(first, "file")
            found = found.withColumns(
                {
                    "header_line": F.col("first.line"),
                    "header_block": F.col("first.block"),
                    "header_place": F.col("first.place"),
                    "marks": marks,
                }
            )
            self.headers = settle(headers.filter(~F.col("several")).unionByName(found.drop("first")))
            self.records = self.records.unionByName(joined)
        self.width = _width(self.headers)
        self.names = _with_names(self.headers, self.width)


def spoilt_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Lines that :func:`read_reports` leaves out, as a stray quote opened a field in them.

    One row per file that has any: ``file`` and ``n_lines``.
    """
    return Reports(spark, directory).spoilt.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"))


def report_columns(spark: SparkSession, directory: str) -> list[str]:
    """All column names in the first records of the reports below a folder, sorted."""
    names = Reports(spark, directory).names.select(F.explode("_names").alias("name")).distinct()
    return sorted(r["name"] for r in names.filter(F.col("name") != "").collect())


def read_reports(
    spark: SparkSession, directory: str, columns: list[str], positions: bool = False
) -> DataFrame:
    """The given columns, by name and as text, of every CSV report below a folder.

    Reports may differ in encoding, separator and columns; a column a report lacks
    is null, and a file with none of them has no rows. The header is a file's first
    record, and only that is left out. Records may go over several lines, whose breaks
    become line feeds; a line that a stray quote spoils is left out, which
    :func:`spoilt_lines` counts. All files are parsed in one scan: each record
    is matched with its file's separator and the places of the wanted columns in its
    header. ``file`` keeps the path, and with ``positions``
    ``block`` and ``place`` keep the order of records within it.
    """
    reports = Reports(spark, directory)
    places = settle(
        reports.names.select(
            "file",
            "header_block",
            "header_place",
            *(
                (F.array_position("_names", F.lit(c)) - 1).cast("int").alias(f"_at{i}")
                for i, c in enumerate(columns)
            ),
        )
    )
    kept = ["file", "block", "place"] if positions else ["file"]
    wanted = F.greatest(*(F.col(f"_at{i}") for i in range(len(columns))), F.lit(-1)) >= 0
    rows = reports.records.join(places.filter(wanted), "file")
    rows = rows.filter((F.col("block") != F.col("header_block")) | (F.col("place") != F.col("header_place")))
    parsed = with_fields(rows, "line", "separator", reports.width, "_fields")
    return parsed.select(
        *kept,
        *(
            F.when(F.col(f"_at{i}") >= 0, F.get("_fields", F.col(f"_at{i}"))).alias(c)
            for i, c in enumerate(columns)
        ),
    )


def report_name(year: Column, topic: str) -> Column:
    return F.concat(year.cast("string"), F.lit(f"_{topic}_bcn"))


def write_reports(
    df: DataFrame,
    path: str,
    year: str,
    topic: str,
    separator: str = ",",
    encoding: str = "UTF-8",
    mode: str = "overwrite",
) -> None:
    """One folder ``report=<year>_<topic>_bcn`` of headed CSV files per year."""
    named = df.withColumn("report", report_name(F.col(year), topic))
    (
        named.hint("rebalance", "report")
        .write.mode(mode)
        .option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("escape", '"')
        .partitionBy("report")
        .csv(path)
    )


def write_indexed_json(
    df: DataFrame, path: str, order: list[str], columns: list[str] | None = None, object_rows: int = OBJECT_ROWS
) -> None:
    """JSON objects that name each row by its place in ``order``: ``{"0": {...}, "1": {...}}``.

    Rows hold ``columns``, or all of them.
    A single object for a whole table would have to pass one task; every line of the files is
    one of ``object_rows`` rows that follow each other.
    """
    row = F.struct(*(columns or df.columns))
    keyed = with_row_index(df, order).select("row_index", row.alias("row"))
    keyed = keyed.withColumn("object", F.floor(F.col("row_index") / object_rows))
    rows = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("row_index").cast("string"), "row"))))
    lines = keyed.groupBy("object").agg(F.to_json(rows).alias("value")).select("value")
    lines.write.mode("overwrite").text(path)


def read_indexed_json(spark: SparkSession, path: str, schema: T.StructType, whole: bool = False) -> DataFrame:
    """The rows of JSON objects keyed by row index, with the key as ``row_index``.

    Objects are one to a line; with ``whole`` every file is one object, over any number of lines.
    """
    rows = T.MapType(T.StringType(), schema)
    lines = spark.read.text(path, wholetext=whole)
    keyed = lines.select(F.explode(F.from_json("value", rows)).alias("key", "row"))
    return keyed.select("row.*", F.col("key").try_cast("long").alias("row_index"))

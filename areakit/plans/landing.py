"""From downloaded reports to the persistent landing zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from areakit.sources.portal import missing_topic_years, present_files
from areakit.sources.reports import read_reports, report_columns, write_indexed_json


def outstanding_years(
    spark: SparkSession, directory: str, topic: str, current_year: int | None = None
) -> DataFrame:
    """Years of a topic for which its folder holds no file yet."""
    return missing_topic_years(present_files(spark, directory), topic, current_year)


def persist_reports(
    spark: SparkSession, directory: str, target: str, columns: list[str] | None = None
) -> None:
    """All yearly reports of a folder as one collection of JSON objects keyed by row index.

    Without ``columns`` every column of any report is kept. The index counts rows in the order
    of file names and of lines within each file. Read it with
    :func:`areakit.sources.reports.read_indexed_json`.
    """
    names = columns or report_columns(spark, directory)
    rows = read_reports(spark, directory, names, positions=True)
    write_indexed_json(rows, target, ["file", "block", "place"], columns=names)

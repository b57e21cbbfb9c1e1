"""Dates and years that only the path of a file tells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FILE_PATH = "_metadata.file_path"


def snapshot_date(path: Column) -> Column:
    """The last ``YYYY_MM_DD`` or ``YYYY-MM-DD`` in a path's folders and name, as a date; null without one.

    Hyphens count only behind ``date=``, as partitioned writes lay dates out.
    """
    text = F.regexp_extract(path, r".*(?:date=(\d{4}-\d{2}-\d{2})|(\d{4}_\d{2}_\d{2}))", 0)
    digits = F.replace(F.right(text, F.lit(10)), F.lit("-"), F.lit("_"))
    return F.try_to_timestamp(digits, F.lit("yyyy_MM_dd")).cast("date")


def report_year(path: Column) -> Column:
    """The year a file's name, or else its folder's, starts with; null without one.

    The name may stand behind ``column=``, as partitioned writes lay it out.
    """

    def leading_year(name: Column) -> Column:
        return F.regexp_extract(name, r"^(?:[^=/]*=)?(\d{4})_", 1).try_cast("int")

    file, folder = (F.substring_index(path, "/", -depth) for depth in (1, 2))
    return F.coalesce(leading_year(file), leading_year(folder))

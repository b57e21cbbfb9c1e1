"""Records of CSV files that go over several lines, found by a scan over lines.

Seen from its start, a line either begins outside quotes or inside a quoted field, and for
each of the two it ends in one state: a line is a function of two states. It is constant, or
keeps the state, or flips it. The state before a line is therefore what the last constant line
before it left, flipped as often as lines have flipped it since. That takes running sums
within each block of a file, which one task has read, and over the summaries of the blocks;
no file comes into one task.

A quote opens a field only at the field's start; elsewhere it is a character like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areakit.session import settle

# A record of more lines, or one that no quote closes, was opened by a stray mark.
MOST_LINES = 200

# Fixed patterns, by separator: a whole quoted field, a quote that opens one, and a quoted
# field that goes on behind its closing quote.
QUOTED = '(^|%s)"[^"]*+(?:""[^"]*+)*+"'
OPENING = '(?:^|%s)"'
TORN = '(?:^|{0})"[^"]*+(?:""[^"]*+)*+"[^{0}]'

KEYS = ["file", "block", "place"]


def _by_separator(separator: Column, separators: tuple[str, ...], of) -> Column:
    found = of(separators[0])
    for mark in separators[1:]:
        found = F.when(separator == mark, of(mark)).otherwise(found)
    return found


def bare(text: Column, mark: str) -> Column:
    """A record without what its quoted fields hold."""
    return F.regexp_replace(text, QUOTED % mark, "$1")


def opens(line: Column, mark: str) -> Column:
    """Whether a line that begins outside quotes ends inside a quoted field."""
    return line.contains('"') & bare(line, mark).rlike(OPENING % mark)


def torn(record: Column, separator: Column, separators: tuple[str, ...]) -> Column:
    """Whether something other than a separator follows a closing quote."""
    return _by_separator(separator, separators, lambda mark: record.rlike(TORN.format(mark)))


def width(record: Column, separator: Column, separators: tuple[str, ...]) -> Column:
    """The number of fields of a whole record."""
    return _by_separator(
        separator, separators, lambda mark: F.size(F.split(bare(record, mark), mark)).cast("int")
    )


def _scanned(df: DataFrame, keys: list[str], order: str, from_outside: str, from_inside: str) -> DataFrame:
    """Adds ``_left`` and ``_odd``: the state before a row is ``_left``, or if that is null the one
    before the first row of its ``keys``, flipped if ``_odd``."""
    outside, inside = F.col(from_outside), F.col(from_inside)
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flip = ((outside != inside) & outside).cast("long")
    summed = df.withColumn("_flips", F.coalesce(F.sum(flip).over(upto), F.lit(0)))
    last = F.max(F.when(outside == inside, F.struct(F.col(order), outside.alias("left"), F.col("_flips")))).over(upto)
    known = summed.withColumn("_last", last)
    odd = (F.col("_flips") - F.coalesce(F.col("_last._flips"), F.lit(0))) % 2 == 1
    return known.withColumns({"_left": F.col("_last.left"), "_odd": odd}).drop("_flips", "_last")


def _flipped(state: Column, odd: Column) -> Column:
    return state != odd


def _placed(lines: DataFrame) -> DataFrame:
    """``lines`` with the ``start`` (block and place) of the record each belongs to, and ``open``:
    whether the line ends inside quotes."""
    scanned = _scanned(lines, ["file", "block"], "place", "from_outside", "from_inside")

    def after(start: bool) -> Column:
        before = _flipped(F.coalesce("_left", F.lit(start)), F.col("_odd"))
        return F.when(before, F.col("from_inside")).otherwise(F.col("from_outside"))

    blocks = scanned.groupBy("file", "block").agg(
        F.max_by(F.struct(after(False).alias("from_outside"), after(True).alias("from_inside")), "place").alias("of")
    )
    blocks = _scanned(blocks.select("file", "block", "of.*"), ["file"], "block", "from_outside", "from_inside")
    entered = blocks.select("file", "block", _flipped(F.coalesce("_left", F.lit(False)), F.col("_odd")).alias("entered"))
    states = scanned.join(entered, ["file", "block"])
    inside = _flipped(F.coalesce("_left", "entered"), F.col("_odd"))
    states = states.withColumn("inside", inside).withColumn(
        "open", F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    )
    states = states.drop("_left", "_odd", "entered")
    own = F.max(F.when(~F.col("inside"), F.struct("block", "place"))).over(
        Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    )
    lasts = states.groupBy("file", "block").agg(F.max(F.when(~F.col("inside"), F.struct("block", "place"))).alias("last"))
    earlier = F.max("last").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    carried = lasts.select("file", "block", earlier.alias("earlier"))
    return states.withColumn("own", own).join(carried, ["file", "block"]).withColumn("start", F.coalesce("own", "earlier")).drop("own", "earlier")


def join_records(lines: DataFrame, separators: tuple[str, ...], most_lines: int = MOST_LINES) -> tuple[DataFrame, DataFrame]:
    """The records of files, and the lines that stray marks spoilt.

    ``lines`` has ``file``, ``block``, ``place`` (the order of lines), ``line`` and ``separator``. A
    record (``file``, ``block`` and ``place`` of its first line, ``line``, ``separator``) has its lines
    joined by line feeds. One of several lines that is longer than ``most_lines``, is not closed
    at the end of the file, has a quoted field that goes on behind its closing quote, or another
    number of fields than the file's first record, was opened by a stray mark. Its lines are then records of their own, and those of them that
    leave a quote open are spoilt. What follows is read as before, since it begins outside
    quotes either way; only a record of several lines that begins on the last of the spoilt
    lines is lost with it, its other lines being read as records.
    """
    separator = F.col("separator")
    marked = lines.withColumns(
        {
            "from_outside": _by_separator(separator, separators, lambda mark: opens(F.col("line"), mark)),
            "from_inside": _by_separator(separator, separators, lambda mark: opens(F.concat(F.lit('"'), F.col("line")), mark)),
        }
    )
    placed = settle(_placed(settle(marked.select(*KEYS, "line", "separator", "from_outside", "from_inside"))))
    sizes = placed.groupBy("file", "start").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("open", F.struct("block", "place")).alias("open")
    )
    long = sizes.filter((F.col("n") > most_lines) | F.col("open")).select("file", "start")
    fits = placed.join(long, ["file", "start"], "left_anti")
    joined = fits.groupBy("file", "start", "separator").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "line"))).alias("of")
    )
    records = settle(
        joined.select(
            "file",
            "start",
            F.array_join("of.line", "\n").alias("line"),
            "separator",
            F.size("of").alias("n"),
        ).withColumn("fields", width(F.col("line"), separator, separators))
    )
    first = records.groupBy("file").agg(F.min_by("fields", "start").alias("expected"))
    odd = (F.col("fields") != F.col("expected")) | torn(F.col("line"), separator, separators)
    odd = records.filter("n > 1").join(first, "file").filter(odd).select("file", "start")
    stray = settle(long.union(odd))
    whole = records.join(stray, ["file", "start"], "left_anti").select("file", "start.*", "line", "separator")
    alone = placed.join(stray, ["file", "start"], "left_semi")
    single = alone.filter(~F.col("from_outside")).select(*KEYS, "line", "separator")
    return whole.unionByName(single), alone.filter("from_outside").select(*KEYS, "line")

"""What the open-data portal offers and what is already here."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areakit.functions.paths import report_year

# The first year each topic was published.
FIRST_YEARS = {"lloguer_preu": 2014, "accidents": 2016}

PORTAL = "https://opendata-ajuntament.barcelona.cat"

# Fixed patterns: an anchor element with its parts.
ANCHOR = r"(?is)<a\s[^>]*>.*?</a>"
HREF = r"""(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
CLASS = r"""(?is)^<a\s(?:[^>]*?\s)?class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TAG = r"(?s)<[^>]*>"

# Fixed pattern, by element: comments, scripts, the tags of an element, and anchors.
PIECES = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<{0}(?:\s[^>]*)?>|</{0}\s*>|<a\s[^>]*>.*?</a>"

# The named character references of markup; the ampersand comes last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def unescaped(text: Column) -> Column:
    for reference, character in ENTITIES.items():
        text = F.replace(text, F.lit(reference), F.lit(character))
    return text


def _attribute(anchor: Column, pattern: str) -> Column:
    """An attribute's value however it is quoted; at most one group matches."""
    return F.concat(*(F.regexp_extract(anchor, pattern, group) for group in (1, 2, 3)))


def _has_classes(tag: Column, pattern: str, classes: str) -> Column:
    own = F.split(unescaped(_attribute(tag, pattern)), r"\s+")
    return F.forall(F.array(*map(F.lit, classes.split())), lambda c: F.array_contains(own, c))


@dataclass(frozen=True)
class Container:
    """An element that has all these classes; links are wanted only from inside it."""

    element: str
    classes: str
    first_only: bool = True


# Where the portal lists a topic's reports, and a report's files.
REPORT_LIST = Container("ul", "resource-list")
DOWNLOADS = Container("div", "actions resource-actions")


def _intervals(pieces: Column, container: Container) -> Column:
    """Where in the page's ``pieces`` the container's elements open and close.

    Counts how many of the container's element are open since it began, itself included, so that
    elements nested in it do not end it. One that is never closed goes on to the end.
    """
    element = container.element
    css = CLASS.replace("<a", f"<{element}")
    opening = lambda tag: tag.rlike(rf"(?is)^<{element}(\s|>)")
    closing = lambda tag: tag.rlike(rf"(?is)^</{element}\s*>")
    marks = F.transform(
        pieces,
        lambda tag, at: F.struct(
            at.alias("at"),
            F.when(opening(tag), 1).when(closing(tag), -1).otherwise(0).alias("step"),
            (opening(tag) & _has_classes(tag, css, container.classes)).alias("begins"),
        ),
    )
    marks = F.filter(marks, lambda mark: mark["step"] != 0)
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("start"), none.alias("found"))

    def step(state: Column, mark: Column) -> Column:
        opened = F.greatest(state["open"] + mark["step"], F.lit(0))
        ends = (state["open"] > 0) & (opened == 0)
        interval = F.struct(state["start"].alias("start"), mark["at"].alias("end"))
        inside = F.struct(
            opened.alias("open"),
            state["start"].alias("start"),
            F.when(ends, F.concat(state["found"], F.array(interval))).otherwise(state["found"]).alias("found"),
        )
        begun = F.struct(F.lit(1).alias("open"), mark["at"].alias("start"), state["found"].alias("found"))
        return F.when(state["open"] > 0, inside).when(mark["begins"], begun).otherwise(state)

    def close(state: Column) -> Column:
        rest = F.struct(state["start"].alias("start"), F.lit(2**31 - 1).alias("end"))
        found = F.when(state["open"] > 0, F.concat(state["found"], F.array(rest))).otherwise(state["found"])
        return F.slice(found, 1, 1) if container.first_only else found

    return F.aggregate(marks, start, step, close)


def present_files(spark: SparkSession, directory: str) -> DataFrame:
    """Paths of all files below a folder that hold anything, without reading them."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(directory)
        .select("path")
    )


def missing_years(files: DataFrame, first: int, end: int) -> DataFrame:
    """The years of ``first <= year < end`` for which no file is present."""
    wanted = files.sparkSession.range(first, end).select(F.col("id").cast("int").alias("year"))
    present = files.select(report_year(F.col("path")).alias("year")).distinct()
    return wanted.join(present, "year", "left_anti")


def missing_topic_years(
    files: DataFrame, topic: str, current_year: int | None = None
) -> DataFrame:
    """The same for a known topic, up to the year before the current one."""
    return missing_years(files, FIRST_YEARS[topic], current_year or date.today().year)


def page_links(
    pages: DataFrame, html: str = "html", css_class: str | None = None, container: Container | None = None
) -> DataFrame:
    """Every anchor with an ``href``: its place in the page, address, and text.

    With ``css_class`` those of that class only, and with ``container`` those inside it, comments
    and scripts left aside; ``pos`` then counts the pieces of the page, anchors among them.
    """
    anchor = F.col("_anchor")
    href = unescaped(_attribute(anchor, HREF))
    rest = [c for c in pages.columns if c != html]
    if container:
        pieces = F.regexp_extract_all(F.col(html), F.lit(PIECES.format(container.element)), F.lit(0))
        cut = pages.select(*rest, pieces.alias("_pieces")).withColumn("_inside", _intervals(F.col("_pieces"), container))
        found = cut.filter(F.size("_inside") > 0).select(*rest, "_inside", F.posexplode("_pieces").alias("pos", "_anchor"))
        within = F.exists("_inside", lambda i: (i["start"] < F.col("pos")) & (F.col("pos") < i["end"]))
        found = found.filter(within).drop("_inside")
    else:
        anchors = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(0))
        found = pages.select(*rest, F.posexplode(anchors).alias("pos", "_anchor"))
    found = found.filter(anchor.rlike(HREF))
    if css_class:
        found = found.filter(_has_classes(anchor, CLASS, css_class))
    return found.select(
        "*", F.trim(href).alias("href"), F.trim(unescaped(F.regexp_replace(anchor, TAG, ""))).alias("text")
    ).drop("_anchor")


def link_title(text: Column) -> Column:
    """The link text without its last three characters, in lower case."""
    return F.lower(F.left(text, F.greatest(F.length(text) - 3, F.lit(0))))


def report_links(
    links: DataFrame, order: list[str], wanted: DataFrame | None = None, base: str = PORTAL
) -> DataFrame:
    """The last link of each year (the first four characters of its title).

    Titles that end in ``xml`` are left out, and years not in the ``year`` column
    of ``wanted``. ``order`` puts links in the order they were met. Links are
    reduced to one per year, first within each partition, before ``wanted`` is
    joined; where that is small Spark moves the join below the aggregation itself.
    """
    titled = (
        links.withColumn("title", link_title(F.col("text")))
        .filter(~F.col("title").endswith("xml"))
        .withColumn("year", F.left("title", F.lit(4)))
    )
    last = titled.groupBy("year").agg(
        F.max_by(F.concat(F.lit(base), F.col("href")), F.struct(*order)).alias("url")
    )
    return last if wanted is None else last.join(wanted.select("year"), "year", "left_semi")

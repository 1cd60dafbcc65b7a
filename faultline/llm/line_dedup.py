"""Lines that most pages of a site share, dropped by their frequency relative to the site.

Pages are grouped by host. A line's share is the number of the host's pages that hold it, over all pages of the host;
a line above the ratio is boilerplate there and goes from every page of that host, and of that host only. A text that
a host repeats raises the share of its own lines, so before near-duplicates are removed ``spare`` keeps such texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import fresh, stored


@dataclass(frozen=True)
class Boilerplate:
    """``ratio``: a line on a larger share of the host's pages goes. ``min_pages``: unless fewer pages hold it.

    ``broadcast_lines``: that many boilerplate lines at most are broadcast (25 bytes each); more are joined.
    ``spare``: no line goes from all pages. Equal texts of a host are one page in both counts; a boilerplate line stays
    on the page that holds it with the smallest hash; and a page that would be left blank keeps all its lines.
    """

    ratio: float = 0.01
    min_pages: int = 5
    broadcast_lines: int = 100_000
    spare: bool = False


def host_of(url: Column) -> Column:
    """The host of a URL, lower-cased; null without one."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, how: Boilerplate = Boilerplate()) -> DataFrame:
    """Host, digest and number of pages of each boilerplate line; with ``how.spare`` also ``first``, the hash of the
    page on which it stays. ``pages``: host, text; one row per page."""
    if how.spare:
        pages = pages.withColumn("page", _digest(F.col("text")))
    totals = pages.groupBy("host").agg((F.count_distinct("page") if how.spare else F.count("*")).alias("host_pages"))
    # a page counts once for a line: its lines are made distinct before anything is shuffled
    own = pages.select(
        *[c for c in pages.columns if c != "text"],
        F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), "\\n", -1))).alias("line"),
    ).filter("trim(line) != ''")
    n_pages, first = F.count("*").alias("pages"), []
    if how.spare:
        own = own.select("host", "page", _digest(F.col("line")).alias("digest")).distinct()
        first = [F.min(F.xxhash64("page")).alias("first")]
    counts = own.groupBy("host", "digest" if how.spare else _digest(F.col("line")).alias("digest")).agg(n_pages, *first)
    return (
        counts.filter(F.col("pages") >= how.min_pages)
        .join(totals, totals["host"].eqNullSafe(counts["host"]))
        .filter(F.col("pages") > how.ratio * F.col("host_pages"))
        .select(counts["host"], "digest", "pages", "host_pages", *(["first"] if how.spare else []))
    )


def drop_boilerplate(
    docs: DataFrame, how: Boilerplate = Boilerplate(), host: str = "source", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with their boilerplate lines gone from ``text``, and ``n_lines``, ``n_dropped`` added.

    Lines end at a line feed; blank lines always stay. What stays keeps its order, joined by line feeds. A null text
    stays null with no lines; an empty one has one line. Rows without a host are one site. Repeated rows are pages of
    their own, unless ``how.spare``. All columns stay; columns of ``docs`` named n_lines or n_dropped are replaced.
    """
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text")).filter("text IS NOT NULL")
    lines = stored(boilerplate(pages, how), "boilerplate")
    site, gone, firsts = fresh(docs, "site", "gone", "firsts")
    listed = [F.collect_list(F.struct("digest", "first") if how.spare else "digest").alias(gone)]
    if how.spare:
        listed.append(F.collect_set("first").alias(firsts))
    sites = lines.groupBy(F.col("host").alias(site)).agg(*listed)
    if lines.count() <= how.broadcast_lines:
        sites = F.broadcast(sites)
    columns = docs.drop("n_lines", "n_dropped").columns
    rows = docs.drop("n_lines", "n_dropped").join(sites, F.col(host).eqNullSafe(F.col(site)), "left")
    if how.spare:
        page = F.xxhash64(_digest(F.col(text)))
        others = F.filter(gone, lambda g: g["first"] != page)
        here = F.when(F.array_contains(F.col(firsts), page), others).otherwise(F.col(gone))
        rows = rows.withColumn(gone, here["digest"])
    split = F.split(F.col(text), "\\n", -1)
    drops = lambda line: (F.trim(line) != "") & F.array_contains(F.col(gone), _digest(line))
    stay = F.when(F.col(gone).isNull(), split).otherwise(F.filter(split, lambda line: ~drops(line)))
    if how.spare:
        stay = F.when(F.exists(stay, lambda line: F.trim(line) != ""), stay).otherwise(split)
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(split)).cast("long")
    n_stay = F.when(F.col(text).isNull(), 0).otherwise(F.size(stay)).cast("long")
    return rows.select(
        *[F.array_join(stay, "\n").alias(c) if c == text else F.col(f"`{c}`") for c in columns],
        n_lines.alias("n_lines"),
        (n_lines - n_stay).alias("n_dropped"),
    )

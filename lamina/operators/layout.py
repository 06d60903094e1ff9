"""Operators over layout blocks: fonts, repeated lines, contents pages, tables on a page.

blocks: doc_id, page, ord, text, x0, y0, x1, y1, font, size, flags; further columns pass through where a row does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .predicates import is_header

#: Fixed value.
FOOTER = r"Guidelines for preparing a submission to the PBAC, Version \d+\.\d+, September \d+"


def font_profile(spans: DataFrame) -> DataFrame:
    """Spans of each document by (font, size, flags)."""
    return spans.groupBy("doc_id", "font", "size", "flags").agg(F.count("*").alias("n"))


def font_order(profile: DataFrame) -> DataFrame:
    """Adds rank: a document's fonts from the most used; ties by font, size and flags."""
    return profile.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "font", "size", "flags")))


def rare_font_headers(blocks: DataFrame, spans: DataFrame, share: float = 0.05, least_size: float = 10.5) -> DataFrame:
    """One-line blocks whose first span has a rare, large font and whose text could be a heading. blocks also has n_lines."""
    total = F.sum("n").over(Window.partitionBy("doc_id"))
    rare = font_profile(spans).withColumn("total", total).filter((F.col("n") / F.col("total") < share) & (F.col("size") > least_size))
    return blocks.filter((F.col("n_lines") == 1) & is_header(F.col("text"))).join(rare.select("doc_id", "font", "size", "flags"), ["doc_id", "font", "size", "flags"], "left_semi")


def repeated_lines(blocks: DataFrame, threshold: float = 0.6, distinct_pages: bool = False) -> DataFrame:
    """Headers and footers: (doc_id, text, kind). blocks also has n_pages and height of the document.

    A text of under 150 characters found more than int(pages * threshold) times, where that is over 1, short or of
    the known footer's form, whose mean top is in the first or last 15 % of the page. Occurrences count, as a rule; distinct_pages counts pages.
    """
    times = F.countDistinct("page") if distinct_pages else F.count("*")
    least = F.floor(F.col("n_pages") * threshold)
    g = blocks.filter((F.length("text") < 150) & (F.length("text") > 0)).groupBy("doc_id", "text").agg(times.alias("n"), F.avg("y0").alias("y"), F.first("n_pages").alias("n_pages"), F.first("height").alias("height"))
    g = g.filter((least > 1) & (F.col("n") > least) & ((F.length("text") < 50) | F.col("text").rlike(FOOTER)))
    kind = F.when(F.col("y") < F.col("height") * 0.15, "header").when(F.col("y") > F.col("height") * 0.85, "footer")
    return g.select("doc_id", "text", kind.alias("kind")).filter("kind is not null")


def strip_repeated(blocks: DataFrame, repeated: DataFrame) -> DataFrame:
    """Blocks whose text is none of the document's repeated lines."""
    return blocks.join(repeated.select("doc_id", "text"), ["doc_id", "text"], "left_anti")


def font_levels(candidates: DataFrame, toc: DataFrame) -> DataFrame:
    """Adds level: the rank of the font size in the document, largest first, below the levels of its contents list."""
    top = toc.groupBy("doc_id").agg(F.max("level").alias("toc_level"))
    rank = F.dense_rank().over(Window.partitionBy("doc_id").orderBy(F.desc("size")))
    return candidates.join(top, "doc_id", "left").withColumn("level", rank + F.coalesce("toc_level", F.lit(0))).drop("toc_level")


def toc_page(pages: DataFrame, first: int = 10) -> DataFrame:
    """The first of a document's first pages that looks like a list of contents: (doc_id, page)."""
    t = F.lower("text")
    hit = t.contains("table of contents") | (t.contains("contents") & (F.length("text") < 2000))
    return pages.filter((F.col("page") <= first) & hit).groupBy("doc_id").agg(F.min("page").alias("page"))


def toc_resolve(toc: DataFrame, blocks: DataFrame) -> DataFrame:
    """Contents entries with the place of the first block on their page of just that text; null where there is none. toc: doc_id, nth, text, level, page."""
    b = blocks.filter((F.length("text") > 5) & (F.length("text") < 200)).groupBy("doc_id", "page", "text").agg(F.min_by(F.struct("x0", "y0", "x1", "y1"), "ord").alias("box"))
    return toc.join(b, ["doc_id", "page", "text"], "left").select("doc_id", "nth", "text", "level", "page", "box.*")


def overlaps(a: str, b: str) -> Column:
    return (F.col(f"{a}.x0") < F.col(f"{b}.x1")) & (F.col(f"{b}.x0") < F.col(f"{a}.x1")) & (F.col(f"{a}.y0") < F.col(f"{b}.y1")) & (F.col(f"{b}.y0") < F.col(f"{a}.y1"))


def spatial_anti(blocks: DataFrame, tables: DataFrame) -> DataFrame:
    """Blocks that meet no table on their page: an equi anti-join on (doc, page) with the boxes' overlap."""
    a, b = blocks.alias("a"), tables.alias("b")
    same = (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.page") == F.col("b.page"))
    return a.join(b, same & overlaps("a", "b"), "left_anti")

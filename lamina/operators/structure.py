"""Heading hierarchy, and which section a block belongs to.

headers: doc_id, ord, text, level, page, y0, y1. Folds run over a document's headings only, which are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def leaf_headers(headers: DataFrame) -> DataFrame:
    """Adds leaf: the next heading isn't deeper, or there is none."""
    nxt = F.lead("level").over(Window.partitionBy("doc_id").orderBy("ord"))
    return headers.withColumn("leaf", nxt.isNull() | (nxt <= F.col("level")))


def section_hierarchy(headers: DataFrame) -> DataFrame:
    """Adds path: the texts from the top heading down. A fold with a stack: headings of the same or a deeper level leave it first."""
    h = headers.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "level", "text"))).alias("hs"))
    start = F.struct(F.array().cast("array<struct<level:int,text:string>>").alias("stack"), F.array().cast("array<struct<ord:int,path:array<string>>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        stack = F.concat(F.filter(a["stack"], lambda s: s["level"] < x["level"]), F.array(F.struct(x["level"].cast("int").alias("level"), x["text"].alias("text"))))
        return F.transform(F.array(stack), lambda s: F.struct(s.alias("stack"), F.concat(a["out"], F.array(F.struct(x["ord"].cast("int").alias("ord"), F.transform(s, lambda e: e["text"]).alias("path")))).alias("out")))[0]

    paths = h.select("doc_id", F.explode(F.aggregate("hs", start, step)["out"]).alias("o")).select("doc_id", F.col("o.ord").alias("ord"), F.col("o.path").alias("path"))
    return headers.join(paths, ["doc_id", "ord"])


def merge_headers(candidates: DataFrame) -> DataFrame:
    """Headings from contents list and fonts in one order with final levels: (doc_id, nth, text, level, page, y0, dummy).

    candidates: doc_id, page, y0, text, level, dummy (no place known), tie (the order given). Sorted by page and top, those without a
    place first. A level over two below what the stack implies, or of a heading without a place, becomes the
    implied one. A heading like the last kept one (text, page, top within 5) goes.
    """
    key = F.struct("page", F.when(F.col("dummy"), float("-inf")).otherwise(F.col("y0")).alias("top"), "tie", "text", F.col("level").cast("int").alias("level"), F.col("y0").cast("double").alias("y0"), "dummy")
    item = "struct<text:string,level:int,page:int,y0:double,dummy:boolean>"
    start = F.struct(F.array().cast("array<int>").alias("stack"), F.array().cast(f"array<{item}>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        stack = F.filter(a["stack"], lambda s: s < x["level"])
        implied = F.coalesce(F.array_max(stack) + 1, F.lit(1))
        level = F.when(x["dummy"] | (x["level"] > implied + 2), implied).otherwise(x["level"])
        last = F.get(a["out"], F.size(a["out"]) - 1)
        y = F.when(x["dummy"], 0.0).otherwise(x["y0"])
        same = F.coalesce((last["text"] == x["text"]) & (last["page"] == x["page"]) & (F.abs(last["y0"] - y) < 5), F.lit(False))
        new = F.struct(x["text"].alias("text"), level.cast("int").alias("level"), x["page"].cast("int").alias("page"), y.alias("y0"), x["dummy"].alias("dummy"))
        return F.struct(
            F.when(same, stack).otherwise(F.concat(stack, F.array(level.cast("int")))).alias("stack"),
            F.when(same, a["out"]).otherwise(F.concat(a["out"], F.array(new))).alias("out"),
        )

    h = candidates.groupBy("doc_id").agg(F.array_sort(F.collect_list(key)).alias("hs"))
    return h.select("doc_id", F.posexplode(F.aggregate("hs", start, step)["out"]).alias("nth", "h")).select("doc_id", "nth", "h.*")


def section_assign(headers: DataFrame, blocks: DataFrame, keep_all: bool = False) -> DataFrame:
    """Blocks with the leaf section they belong to: (doc_id, ord, header_ord); keep_all: every block, all its columns, header_ord null where it is in none.

    A leaf's section runs from below it to the next heading, and ends at the first block, in the order given, at or
    after that boundary. A range join: a page's blocks meet only the leaves that reach that page.
    """
    w = Window.partitionBy("doc_id").orderBy("ord")
    h = headers.select("doc_id", F.col("ord").alias("header_ord"), F.col("page").alias("hp"), F.col("y1").alias("hy"), F.lead("page").over(w).alias("np"), F.lead("y0").over(w).alias("ny"), F.lead("level").over(w).alias("nl"), "level")
    h = h.filter(F.col("nl").isNull() | (F.col("nl") <= F.col("level")))
    b = blocks if keep_all else blocks.select("doc_id", "ord", "page", "y0")
    # a leaf meets the blocks of the pages from its own to its boundary's: an equality on document and page, no more
    last = blocks.groupBy("doc_id").agg(F.max("page").alias("last"))
    h = h.join(last, "doc_id").withColumn("end", F.coalesce("np", "last")).filter("end >= hp")
    h = h.withColumn("page", F.explode(F.sequence(F.col("hp").cast("int"), F.col("end").cast("int")))).select("doc_id", "page", "header_ord", "hp", "hy", "np", "ny")
    after = (F.col("page") > F.col("hp")) | ((F.col("page") == F.col("hp")) & (F.col("y0") >= F.col("hy")))
    at_end = F.col("np").isNotNull() & ((F.col("page") > F.col("np")) | ((F.col("page") == F.col("np")) & (F.col("y0") >= F.col("ny"))))
    j = b.join(h, ["doc_id", "page"], "left").withColumn("inside", F.coalesce(after, F.lit(False)))
    seen = F.max((F.col("inside") & at_end).cast("int")).over(Window.partitionBy("doc_id", "header_ord").orderBy("page", "ord").rowsBetween(Window.unboundedPreceding, 0))
    j = j.withColumn("inside", F.col("inside") & (seen == 0))
    if not keep_all:
        return j.filter("inside").select("doc_id", "ord", "header_ord")
    block = Window.partitionBy("doc_id", "page", "ord")
    some, first = F.max("inside").over(block), F.row_number().over(block.orderBy("header_ord"))
    j = j.withColumn("__some", some).withColumn("__nth", first).filter(F.col("inside") | (~F.col("__some") & (F.col("__nth") == 1)))
    return j.select(*blocks.columns, F.when(F.col("inside"), F.col("header_ord")).alias("header_ord"))


def section_asof(headers: DataFrame, blocks: DataFrame, keep_all: bool = False) -> DataFrame:
    """section_assign() for headings in order of their place, (page, y0) with y0 <= y1, as merge_headers() gives them: an as-of join, with no row for a leaf and page.

    Then a block can only be in the section of the last heading that ends above it: a running maximum over headings and blocks in one order. Where that heading's section ends
    early, at the first block in the order given that lies at or after the next heading, is a running minimum over that page. Rows are those of headings and
    blocks, once each; the text of blocks is shuffled once.
    """
    w = Window.partitionBy("doc_id").orderBy("ord")
    h = headers.select("doc_id", F.col("ord").alias("header_ord"), F.col("page").cast("int").alias("hp"), F.col("y1").cast("double").alias("hy"), F.lead("page").over(w).cast("int").alias("np"), F.lead("y0").over(w).cast("double").alias("ny"), F.lead("level").over(w).alias("nl"), "level")
    h = h.select("doc_id", "header_ord", "hp", "hy", "np", "ny", (F.col("nl").isNull() | (F.col("nl") <= F.col("level"))).alias("leaf"))
    # ends: the place from which a block on the next heading's page ends the section; blocks come first where they are level with it
    ends = h.filter("leaf and np is not null").select("doc_id", F.col("np").alias("page"), F.when(F.col("np") == F.col("hp"), F.greatest("ny", "hy")).otherwise(F.col("ny")).alias("y"), F.lit(1).alias("is_end"), F.lit(None).cast(blocks.schema["ord"].dataType).alias("ord"), "header_ord")
    marks = blocks.select("doc_id", F.col("page").cast("int").alias("page"), F.col("y0").cast("double").alias("y"), F.lit(0).alias("is_end"), "ord", F.lit(None).cast(headers.schema["ord"].dataType).alias("header_ord"))
    below = Window.partitionBy("doc_id", "page").orderBy(F.desc("y"), "is_end").rowsBetween(Window.unboundedPreceding, 0)
    stops = marks.unionByName(ends).withColumn("stop", F.min("ord").over(below)).filter("is_end = 1").select("doc_id", "header_ord", "stop")
    h = h.join(stops, ["doc_id", "header_ord"], "left")
    mark = F.struct("header_ord", "leaf", "np", "ny", "stop")
    b = blocks if keep_all else blocks.select("doc_id", "ord", "page", "y0")
    box = F.struct(*b.columns)
    none = F.lit(None).cast(b.select(box.alias("b")).schema["b"].dataType)
    starts = h.select("doc_id", F.col("hp").alias("__page"), F.col("hy").alias("__y"), F.lit(0).alias("__kind"), mark.alias("__h"), none.alias("__b"))
    rows = b.select("doc_id", F.col("page").cast("int").alias("__page"), F.col("y0").cast("double").alias("__y"), F.lit(1).alias("__kind"), F.lit(None).cast(starts.schema["__h"].dataType).alias("__h"), box.alias("__b"))
    above = Window.partitionBy("doc_id").orderBy("__page", "__y", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    j = starts.unionByName(rows).withColumn("__in", F.max("__h").over(above)).filter("__kind = 1")
    s = F.col("__in")
    before = s["np"].isNull() | (F.col("__page") < s["np"]) | ((F.col("__page") == s["np"]) & (F.col("__y") < s["ny"]))
    stopped = (F.col("__page") == s["np"]) & (F.col("__b.ord") > s["stop"])
    inside = F.coalesce(s["leaf"] & before & ~F.coalesce(stopped, F.lit(False)), F.lit(False))
    out = j.select("__b.*", F.when(inside, s["header_ord"]).alias("header_ord"))
    return out.select(*b.columns, "header_ord") if keep_all else out.filter("header_ord is not null").select("doc_id", "ord", "header_ord")


def section_text(assigned: DataFrame, blocks: DataFrame) -> DataFrame:
    """Text and pages of each section: (doc_id, header_ord, text, pages)."""
    j = assigned.join(blocks, ["doc_id", "ord"])
    g = j.groupBy("doc_id", "header_ord").agg(F.array_sort(F.collect_list(F.struct("page", "ord", "text"))).alias("bs"), F.array_sort(F.collect_set("page")).alias("pages"))
    return g.select("doc_id", "header_ord", F.array_join(F.transform("bs", lambda b: b["text"]), "\n\n").alias("text"), "pages")


def orphan_blocks(blocks: DataFrame, headers: DataFrame, assigned: DataFrame) -> DataFrame:
    """Blocks that are neither headings (same page and box; y0 and what else of the box both sides have) nor in a section."""
    box = ["doc_id", "page", *[c for c in ("x0", "y0", "x1", "y1") if c in blocks.columns and c in headers.columns]]
    rest = blocks.join(headers.select(*box), box, "left_anti")
    return rest.join(assigned.select("doc_id", "ord"), ["doc_id", "ord"], "left_anti")


def section_pages(headers: DataFrame, blocks: DataFrame) -> DataFrame:
    """(doc_id, ord, header_ord): the older assignment, for every heading, with whole pages as bounds.

    A heading's section has the blocks below it on its page, and those of the pages after it up to the first page that holds another
    heading of its level or a higher one. On its own page such a heading, met in block order below it, ends the section at once. headers and blocks: doc_id, ord, page, y0; headers: level.
    """
    h = headers.select("doc_id", F.col("ord").alias("header_ord"), F.col("page").alias("hp"), F.col("y0").alias("hy"), F.col("level").alias("hl"))
    o = headers.select("doc_id", F.col("ord").alias("o"), F.col("page").alias("op"), F.col("y0").alias("oy"), F.col("level").alias("ol"))
    rival = (F.col("ol") <= F.col("hl")) & (F.col("o") != F.col("header_ord"))
    j = h.join(o, "doc_id", "left")  # headings of one document
    bounds = j.groupBy("doc_id", "header_ord", "hp", "hy").agg(F.min(F.when(rival & (F.col("op") > F.col("hp")), F.col("op"))).alias("end"), F.min(F.when(rival & (F.col("op") == F.col("hp")) & (F.col("oy") > F.col("hy")), F.col("o"))).alias("stop"))
    last = blocks.groupBy("doc_id").agg(F.max("page").alias("last"))
    to = F.when(F.col("stop").isNotNull(), F.col("hp")).otherwise(F.coalesce(F.col("end") - 1, F.col("last")))
    spread = bounds.join(last, "doc_id").withColumn("page", F.explode(F.when(to >= F.col("hp"), F.sequence(F.col("hp").cast("int"), to.cast("int"))).otherwise(F.array(F.col("hp").cast("int")))))
    b = blocks.select("doc_id", "ord", F.col("page").cast("int").alias("page"), "y0").join(spread, ["doc_id", "page"])
    below = (F.col("page") > F.col("hp")) | (F.col("y0") > F.col("hy"))
    return b.filter(below & (F.col("stop").isNull() | (F.col("ord") < F.col("stop")))).select("doc_id", "ord", "header_ord")

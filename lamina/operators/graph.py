"""The graph of documents, pages and entities as node and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pages(docs: DataFrame) -> DataFrame:
    """docs: document_id, source_file, pages array<struct<page_number, entities, ...>>."""
    return docs.select("document_id", "source_file", F.explode("pages").alias("p")).select("document_id", "source_file", "p.*")


def page_id(doc: str = "document_id", page: str = "page_number"):
    return F.concat_ws("_page_", F.col(doc).cast("string"), F.col(page).cast("string"))


def entities(docs: DataFrame) -> DataFrame:
    """(document_id, page_number, name), a row for each mention with a name."""
    e = _pages(docs).select("document_id", "page_number", F.explode("entities").alias("name"))
    return e.filter(F.coalesce("name", F.lit("")) != "")


def nodes(docs: DataFrame) -> DataFrame:
    """(id, label), each node once: documents, pages, entities by name."""
    d = docs.select(F.col("document_id").cast("string").alias("id"), F.lit("Document").alias("label"))
    p = _pages(docs).select(page_id().alias("id"), F.lit("Page").alias("label"))
    e = entities(docs).select(F.col("name").alias("id"), F.lit("Entity").alias("label"))
    return d.unionByName(p).unionByName(e).dropDuplicates(["id", "label"])


def edges(docs: DataFrame) -> DataFrame:
    """(src, dst, type), each edge once: HAS_PAGE and MENTIONS."""
    p = _pages(docs).select(F.col("document_id").cast("string").alias("src"), page_id().alias("dst"), F.lit("HAS_PAGE").alias("type"))
    e = entities(docs).select(page_id().alias("src"), F.col("name").alias("dst"), F.lit("MENTIONS").alias("type"))
    return p.unionByName(e).dropDuplicates(["src", "dst", "type"])


def checked_edges(found: DataFrame, known: DataFrame) -> DataFrame:
    """Edges whose ends are both nodes (id, label): documents have pages, and pages mention entities. An edge without its parent isn't made."""
    ends = lambda kind, name: known.filter(F.col("label") == kind).select(F.col("id").alias(name))
    page = found.filter("type = 'HAS_PAGE'").join(ends("Document", "src"), "src", "left_semi").join(ends("Page", "dst"), "dst", "left_semi")
    mention = found.filter("type = 'MENTIONS'").join(ends("Page", "src"), "src", "left_semi").join(ends("Entity", "dst"), "dst", "left_semi")
    return page.unionByName(mention).select("src", "dst", "type")


def merge(old_nodes: DataFrame, old_edges: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a graph with further documents in it: what is there stays, what is new is added once, edges only between nodes that are there."""
    every = old_nodes.unionByName(nodes(docs)).dropDuplicates(["id", "label"])
    found = old_edges.unionByName(edges(docs)).dropDuplicates(["src", "dst", "type"])
    return every, checked_edges(found, every)

"""The document flow end to end: blocks to sections to chunks, checked; chunks to enriched rows to vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.config import Config
from ..operators import layout as L
from ..operators import structure as S
from ..sources import pdf


def table_chunks(tables: DataFrame) -> DataFrame:
    """A chunk for each table that has a summary: its text is the summary, its raw content the stripped markdown, or null if that is blank.

    tables: doc_id, table_id, page, llm_summary, markdown.
    """
    t = tables.filter(F.coalesce("llm_summary", F.lit("")) != "")
    ident = F.sha2(F.concat_ws("|", F.lit("table"), F.col("doc_id").cast("string"), F.col("table_id").cast("string"), "llm_summary"), 256)
    return t.select(
        ident.alias("chunk_id"), "doc_id", F.array(F.lit("Tables"), F.concat(F.lit("Page "), F.col("page").cast("string"))).alias("section_path"), F.array(F.col("page").cast("int")).alias("page_numbers"),
        F.lit("table_summary").alias("chunk_type"), F.col("llm_summary").alias("text"), F.col("table_id").cast("string").alias("table_id"), F.nullif(T.strip(F.col("markdown")), F.lit("")).alias("raw_table_content"),
    )


def chunk_documents(headers: DataFrame, blocks: DataFrame, config: Config | None = None, tables: DataFrame | None = None) -> DataFrame:
    """Chunks of documents: (chunk_id, doc_id, section_path, page_numbers, chunk_type, text), with table_id and raw_table_content where tables are given.

    Leaf sections, then what belongs to none ("Miscellaneous Content"; "Unstructured Document" where a document has no
    heading), cut by the sizes of the section's rule. Where blocks have a block_type only those of text count; tables make chunks of their
    own (table_chunks()). Ids are digests of document, section, ordinal and text, so a repeat gives the same.
    """
    config = config or Config()
    if "block_type" in blocks.columns:
        blocks = blocks.filter("block_type = 'text'")
    paths = S.section_hierarchy(headers).select("doc_id", F.col("ord").alias("header_ord"), "path")
    # one pass over the blocks: each with its section, if it has one, and whether it is a heading itself
    placed = S.section_asof(headers, blocks, keep_all=True)
    box = ["doc_id", "page", *[c for c in ("x0", "y0", "x1", "y1") if c in blocks.columns and c in headers.columns]]
    marked = placed.join(headers.select(*box).distinct().withColumn("is_header", F.lit(True)), box, "left")
    marked = marked.filter(F.col("header_ord").isNotNull() | F.col("is_header").isNull())
    bs = F.array_sort(F.collect_list(F.struct("page", "ord", "text")))
    every = marked.groupBy("doc_id", F.coalesce("header_ord", F.lit(-1)).alias("header_ord")).agg(bs.alias("bs"), F.array_sort(F.collect_set("page")).alias("pages"))
    titled = headers.select("doc_id").distinct().withColumn("titled", F.lit(True))
    every = every.join(paths, ["doc_id", "header_ord"], "left").join(titled, "doc_id", "left")
    name = F.when(F.col("titled"), "Miscellaneous Content").otherwise("Unstructured Document")
    path = F.when(F.col("header_ord") >= 0, T.clean_path(F.col("path"))).otherwise(F.array(name))
    every = every.select("doc_id", "header_ord", F.array_join(F.transform("bs", lambda b: b["text"]), "\n\n").alias("text"), "pages", path.alias("path"))
    size, overlap = T.adaptive_size(F.col("path"), config.rules, config.default_chunk)
    size, overlap = (F.when(F.col("header_ord") >= 0, c).otherwise(d) for c, d in zip((size, overlap), config.default_chunk, strict=True))
    parts = every.withColumn("size", size).withColumn("overlap", overlap)
    parts = parts.select("doc_id", "header_ord", "pages", "path", F.posexplode(T.sentence_chunks(T.sentences(F.col("text")), F.col("size"), F.col("overlap"))).alias("nth", "text"))
    ident = F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), F.array_join("path", ">"), F.col("header_ord").cast("string"), F.col("nth").cast("string"), "text"), 256)
    out = parts.select(ident.alias("chunk_id"), "doc_id", F.col("path").alias("section_path"), F.col("pages").alias("page_numbers"), F.lit("semantic_text").alias("chunk_type"), "text")
    if tables is None:
        return out
    none = F.lit(None).cast("string")
    return out.withColumns({"table_id": none, "raw_table_content": none}).unionByName(table_chunks(tables))


def flagship(docs: DataFrame) -> DataFrame:
    """Documents cleaned, cut into word windows, judged, and summed by language: (lang, chunks, low_value, chars)."""
    from ..operators.predicates import low_value

    w = docs.select("lang", F.explode(T.word_windows(T.normalize_text(F.col("text")), 128, 32)).alias("chunk"))
    return w.groupBy("lang").agg(F.count("*").alias("chunks"), F.count_if(low_value(F.col("chunk"))).alias("low_value"), F.sum(F.length("chunk")).alias("chars"))


def pdf_layout(read: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headings, blocks, tables) of the pages that sources.pdf.pages() read, as chunk_documents() takes them.

    Repeated headers and footers and what lies in a table are no text; headings come from the bookmarks and from rare, large fonts, merged. The
    file's path stands for the document. Tables have no summary yet (operators.models.table_summaries() makes them).
    """
    blocks, toc, tables = pdf.page_blocks(read), pdf.contents(read), pdf.page_tables(read)
    counts = read.filter("error is null").groupBy(F.col("path").alias("doc_id")).agg(F.count("*").alias("n_pages"))
    repeated = L.repeated_lines(blocks.join(counts, "doc_id"))
    body = L.spatial_anti(L.strip_repeated(blocks, repeated), tables)
    found = L.font_levels(L.rare_font_headers(body, pdf.page_spans(read)), toc)
    place = L.toc_resolve(toc, body)
    entry = place.select("doc_id", "page", F.coalesce("y0", F.lit(0.0)).alias("y0"), "text", F.col("level").cast("int").alias("level"), F.col("y0").isNull().alias("dummy"), F.col("nth").alias("tie"))
    entry = entry.unionByName(found.select("doc_id", "page", "y0", "text", F.col("level").cast("int").alias("level"), F.lit(False).alias("dummy"), (F.col("ord") + 1_000_000).alias("tie")))
    merged = S.merge_headers(entry)
    ends = body.groupBy("doc_id", "page", "y0").agg(F.max("y1").alias("y1"))
    heads = merged.join(ends, ["doc_id", "page", "y0"], "left").select("doc_id", F.col("nth").alias("ord"), "text", "level", "page", "y0", F.coalesce("y1", "y0").alias("y1"))
    return heads, body, tables


def packed_chunks(text: Column, doc_id: Column, size: int, overlap: int) -> Column:
    """A text's chunks in its own row: an array of (nth, chunk_id, text, n_chars, low_value). The text is cleaned and its sentences are packed; ids are digests of document, ordinal and text."""
    from ..operators.predicates import low_value

    def one(t: Column, nth: Column) -> Column:
        ident = F.sha2(F.concat_ws("|", doc_id.cast("string"), nth.cast("string"), t), 256)
        return F.struct(nth.alias("nth"), ident.alias("chunk_id"), t.alias("text"), F.length(t).alias("n_chars"), low_value(t).alias("low_value"))

    packed = T.sentence_chunks(T.sentences(T.normalize_text(F.coalesce(text, F.lit("")))), size, overlap)
    return F.transform(packed, one)

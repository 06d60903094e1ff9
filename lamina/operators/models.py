"""Steps around models: extraction with placeholders, summaries, embeddings, classification, OCR; all through pluggable providers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_hierarchy
from ..functions.jsonx import fenced, is_json, or_fallback, repair_stage
from ..functions.text import parse_page_name, strip, title_guess
from .calls import Asker, Calls, Factory, call_model
from .enrich import render

#: Fixed values.
FIELDS = ("doc_title", "drug_name", "indication", "sponsor")
PLACEHOLDER = "Extraction Failed"
MIME = {".pdf": "application/pdf", ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", ".txt": "text/plain"}
METADATA = "struct<" + ",".join(f"{f}:struct<value:string,confidence:double,justification:string>" for f in FIELDS) + ">"


def first_pages(pages: DataFrame, n: int = 3) -> DataFrame:
    """(doc_id, context): the text of a document's first n pages in order."""
    p = pages.filter(F.col("page") <= n).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("ps"))
    return p.select("doc_id", F.array_join(F.transform("ps", lambda x: x["text"]), "\n").alias("context"))


def triage(docs: DataFrame, pages: DataFrame, n: int = 5) -> DataFrame:
    """(doc_id, mean_chars, method, confidence) of every document: the mean length of the first pages' stripped text, for the log; a document with a
    page is analysed, whatever its text's length, and one without is empty."""
    t = pages.filter(F.col("page") <= n).groupBy("doc_id").agg(F.avg(F.length(strip(F.coalesce("text", F.lit(""))))).alias("mean_chars"))
    j = docs.select("doc_id").join(t, "doc_id", "left")
    found = F.col("mean_chars").isNotNull()
    return j.select("doc_id", "mean_chars", F.when(found, "vector_analysis").otherwise("empty_document").alias("method"), F.when(found, 1.0).otherwise(0.0).alias("confidence"))


def page_counts(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages of each document, 0 for those that couldn't be read."""
    n = pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"))
    return docs.select("doc_id").join(n, "doc_id", "left").na.fill(0, ["n_pages"])


def global_metadata(pages: DataFrame, factory: Factory, calls: Calls | None = None) -> DataFrame:
    """(doc_id, metadata, error): a document's metadata from its first pages; on an error the placeholder, and the run goes on."""
    asked = call_model(first_pages(pages).withColumn("prompt", render("global_metadata", text=F.col("context"))).select("doc_id", "prompt"), "prompt", factory, calls=calls)
    raw = fenced(F.col("answer"))
    bad = F.col("error").isNotNull() | ~F.coalesce(is_json(raw), F.lit(False))
    empty = F.struct(*[F.struct(F.lit(PLACEHOLDER).alias("value"), F.lit(0.0).alias("confidence"), F.lit("error").alias("justification")).alias(f) for f in FIELDS])
    return asked.select("doc_id", F.when(bad, empty).otherwise(F.from_json(raw, METADATA)).alias("metadata"), F.when(F.col("error").isNotNull(), F.col("error")).when(bad, "not JSON").alias("error"))


def table_summaries(tables: DataFrame, factory: Factory, calls: Calls | None = None) -> DataFrame:
    """Tables (doc_id, table_id, markdown) with llm_summary: without markdown a note, no call; an error's text stands for the summary."""
    blank = strip(F.coalesce("markdown", F.lit(""))) == ""
    none = tables.filter(blank).withColumn("llm_summary", F.lit("N/A (no table content)"))
    asked = call_model(tables.filter(~blank).withColumn("prompt", render("table_summary", table=F.col("markdown"))), "prompt", factory, calls=calls)
    asked = asked.withColumn("llm_summary", F.coalesce("answer", "error")).drop("prompt", "answer", "error")
    return asked.unionByName(none)


def offline_embedder(dims: int = 8) -> Callable[[], Callable[[str], list[float]]]:
    """A stand-in model: unit vectors from digests."""
    def factory():
        def embed(text: str) -> list[float]:
            raw = hashlib.sha256(text.encode()).digest()[:dims]
            norm = sum(b * b for b in raw) ** 0.5 or 1.0
            return [b / norm for b in raw]

        return embed

    return factory


def embed(df: DataFrame, column: str, factory: Callable[[], Callable[[str], list[float]]], calls: Calls | None = None) -> DataFrame:
    """Adds embedding: empty for blank texts, which the model isn't asked about, and for those it fails on. Calls run by the rules of `calls`."""
    calls, at = calls or Calls(), len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker = Asker(factory, calls)
        for b, results in asker.batches((b, b.column(at).to_pylist()) for b in batches):
            # an empty vector is retried by the next run
            out = pa.array([[float(x) for x in v or []] for v, _ in results], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:at], out], [*b.schema.names[:at], "embedding"])

    blank = strip(F.coalesce(column, F.lit(""))) == ""
    asked = df.withColumn("__text", F.when(~blank, F.col(column)))
    return asked.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", embedding array<double>")


def classify(docs: DataFrame, factory: Factory, chars: int = 1500, least: int = 100, calls: Calls | None = None) -> DataFrame:
    """(doc_id, summary, tags, classification): texts of `least` characters or more are shown to the model up to `chars`; what isn't JSON is for manual review."""
    long = docs.filter(F.length("text") >= least).select("doc_id", F.substring("text", 1, chars).alias("shown"))
    asked = call_model(long, "shown", factory, calls=calls)
    out = or_fallback(F.coalesce("answer", F.lit("")))
    return asked.select("doc_id", out.alias("o")).select("doc_id", "o.*")


#: Limits of the variants: characters that the model is shown, and the least stripped length that is worth a call.
SHOWN = {"classifier": (1500, 100), "summary": (4000, 30), "labeller": (600, 0)}
#: What stands where no call was made, or it failed.
TOO_SHORT, NOT_ASKED, CALL_FAILED = "Text too short for classification", "n/a", "gemini_error"


def summarise(docs: DataFrame, factory: Factory, calls: Calls | None = None) -> DataFrame:
    """(doc_id, summary, tags, classification) of every document: short texts aren't shown to the model; a failing call and an answer that isn't JSON have their marks."""
    chars, least = SHOWN["summary"]
    short = F.length(strip(F.coalesce("text", F.lit("")))) < least
    none = lambda why: (F.lit("").alias("summary"), F.array().cast("array<string>").alias("tags"), F.lit(why).alias("classification"))
    asked = call_model(docs.filter(~short).select("doc_id", F.substring("text", 1, chars).alias("shown")), "shown", factory, calls=calls)
    read = F.when(F.col("error").isNull(), or_fallback(F.col("answer"))).otherwise(F.struct(*none(CALL_FAILED)))
    return asked.select("doc_id", read.alias("o")).select("doc_id", "o.*").unionByName(docs.filter(short).select("doc_id", *none(NOT_ASKED)))


def classify_typed(docs: DataFrame, factory: Factory, calls: Calls | None = None) -> DataFrame:
    """(doc_id, doc_type, topics, error): the classifier; too short a text, a failing call and an answer that isn't JSON are errors."""
    chars, least = SHOWN["classifier"]
    short = F.length(strip(F.coalesce("text", F.lit("")))) < least
    asked = call_model(docs.filter(~short).select("doc_id", F.substring("text", 1, chars).alias("shown")), "shown", factory, calls=calls)
    j = F.from_json("answer", "`Document Type` string, Topics array<string>")
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(~F.coalesce(is_json(F.col("answer")), F.lit(False)), "not JSON")
    out = asked.select("doc_id", j["Document Type"].alias("doc_type"), j["Topics"].alias("topics"), error.alias("error"))
    return out.unionByName(docs.filter(short).select("doc_id", F.lit(None).cast("string").alias("doc_type"), F.lit(None).cast("array<string>").alias("topics"), F.lit(TOO_SHORT).alias("error")))


def label(docs: DataFrame, factory: Factory, calls: Calls | None = None) -> DataFrame:
    """(doc_id, detected_type, topics, llm_reasoning, error) of every document, asked once: the labeller of golden files, on a preview. A failing call and an answer that isn't JSON are errors."""
    asked = call_model(docs.select("doc_id", F.substring(F.coalesce("text", F.lit("")), 1, SHOWN["labeller"][0]).alias("shown")), "shown", factory, calls=calls)
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(~F.coalesce(is_json(F.col("answer")), F.lit(False)), "not JSON")
    read = lambda path: F.when(F.col("error").isNull(), F.get_json_object("answer", path))
    return asked.withColumn("error", error).select("doc_id", first_label(read("$.document_type")).alias("detected_type"), F.from_json(read("$.topics"), "array<string>").alias("topics"), read("$.reasoning").alias("llm_reasoning"), "error")


def with_defaults(docs: DataFrame, extracted: DataFrame) -> DataFrame:
    """Documents with what was extracted (doc_id, title, doc_type), defaults where nothing was: the title guessed from the text, type Unknown; and the time."""
    j = docs.join(extracted, "doc_id", "left")
    return j.withColumns({"title": F.coalesce("title", title_guess(F.col("text"))), "doc_type": F.coalesce("doc_type", F.lit("Unknown")), "extracted_at": F.current_timestamp()})


def extraction_envelope(docs: DataFrame, extracted: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, metadata, text): source file, page count, time and what was extracted, for every document. docs: doc_id, source, text."""
    n = pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"))
    j = with_defaults(docs.join(n, "doc_id", "left").na.fill(0, ["n_pages"]), extracted)
    meta = F.struct(F.col("source").alias("source_file"), F.col("n_pages").alias("page_count"), "extracted_at", "title", "doc_type")
    return j.select("doc_id", meta.alias("metadata"), "text")


#: Single-valued fields of page-wise extraction.
PAGE_FIELDS = ("title", "doc_type", "pbac_meeting_date", "drug_name", "sponsor", "indication", "outcome")
NOTHING_READ = "No data could be extracted from any page."


def extract_pages(docs: DataFrame, pages: DataFrame, factory: Factory, calls: Calls | None = None) -> DataFrame:
    """(doc_id, fields..., sections, error): every page with text goes to the model, and the pages' answers are merged.

    Of a field the first page's value that isn't empty counts; section lists are joined, each section with the number of its page among those
    that were read. Pages whose call or JSON fails are left out; a document without a page left has an error.
    """
    shown = pages.filter(strip(F.coalesce("text", F.lit(""))) != "").withColumn("__prompt", render("page_extraction", page=F.col("page").cast("string"), text=F.col("text")))
    asked = call_model(shown.select("doc_id", "page", "__prompt"), "__prompt", factory, calls=calls)
    ok = asked.filter(F.col("error").isNull() & F.coalesce(is_json(F.col("answer")), F.lit(False)))
    schema = ", ".join(f"{f} string" for f in PAGE_FIELDS) + ", page_sections array<struct<heading:string,text:string>>"
    read = ok.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("page")).alias("page"), F.from_json("answer", schema).alias("a")).select("doc_id", "page", "a.*")
    # one pass over the answers: a second reading of them would ask the model again
    full = lambda f: F.min(F.when(F.coalesce(F.col(f), F.lit("")) != "", F.struct("page", F.col(f).alias("v"))))["v"]
    lists = F.array_sort(F.collect_list(F.struct("page", F.coalesce("page_sections", F.array().cast("array<struct<heading:string,text:string>>")).alias("s"))))
    sections = F.flatten(F.transform(lists, lambda p: F.transform(F.filter(p["s"], lambda s: s["heading"].isNotNull() & s["text"].isNotNull()), lambda s: F.struct(s["heading"].alias("heading"), s["text"].alias("text"), p["page"].alias("page_start")))))
    merged = read.groupBy("doc_id").agg(*[full(f).alias(f) for f in PAGE_FIELDS], sections.alias("sections"))
    return docs.select("doc_id").join(merged, "doc_id", "left").withColumn("error", F.when(F.col("sections").isNull(), NOTHING_READ))


def extract_documents(files: DataFrame, factory: Factory, schema: str, calls: Calls | None = None) -> DataFrame:
    """(path, fields of the schema, error): whole files of a known MIME type go to the model at once; unknown types, failing calls and answers that aren't JSON are errors.

    files: path, ext, text.
    """
    good, bad = mime_split(files)
    asked = call_model(good.withColumn("__prompt", render("document_extraction", text=F.col("text"))), "__prompt", factory, calls=calls)
    raw = fenced(F.col("answer"))
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(~F.coalesce(is_json(raw), F.lit(False)), "not JSON")
    out = asked.select("path", F.when(error.isNull(), F.from_json(raw, schema)).alias("fields"), error.alias("error"))
    return out.unionByName(bad.select("path", F.lit(None).cast(out.schema["fields"].dataType).alias("fields"), F.concat(F.lit("Unsupported file type: "), "ext").alias("error")))


def repair_with_model(df: DataFrame, column: str, factory: Factory, calls: Calls | None = None) -> DataFrame:
    """repair_stage() with a third try: what mending can't make JSON is shown to the model; stage is then 'model', or 'failed'."""
    staged = repair_stage(df, column)
    # rows that need no third try have no prompt, and pass unasked
    asked = call_model(staged.withColumn("__prompt", F.when(F.col("stage") == "failed", render("json_repair", text=F.col(column)))), "__prompt", factory, "__answer", "__error", calls)
    fixed = fenced(F.col("__answer"))
    ok = F.coalesce(is_json(fixed), F.lit(False))
    return asked.withColumns({column: F.when(ok, fixed).otherwise(F.col(column)), "stage": F.when(ok, "model").otherwise(F.col("stage"))}).select(staged.columns)


def page_type_text(page_type: Column, content: Column) -> Column:
    """A page's text for embedding, with what kind of page it is; nothing for a page without content."""
    text = F.concat(F.lit("This page is classified as `"), F.coalesce(page_type, F.lit("unknown")), F.lit("` and contains the following content: "), content)
    return F.when(F.coalesce(content, F.lit("")) == "", "").otherwise(text)


TOOL = "content_extractor.py"


def envelope(pages: DataFrame) -> DataFrame:
    """(metadata, content) of raw pages (file, source_file, classified_page_type, raw_text, modified): document, page, kind, tool, date and time."""
    document, page = parse_page_name(F.col("file"))
    name, folder = F.regexp_extract("source_file", r"([^/]*)$", 1), F.regexp_extract("source_file", r"^(.*)/", 1)
    day, source, sure = date_hierarchy(F.coalesce("raw_text", F.lit("")), folder, name, F.col("modified"))
    known = F.coalesce(document, F.lit("Unknown")) != "Unknown"
    metadata = F.struct(
        F.when(known, F.concat(document, F.lit(".pdf"))).otherwise("Unknown").alias("source_document"), F.coalesce(page.cast("string"), F.lit("Unknown")).alias("source_page_number"), F.current_timestamp().alias("processing_timestamp"),
        F.coalesce("classified_page_type", F.lit("Unknown")).alias("classified_page_type"), F.lit(TOOL).alias("extraction_tool_used"), F.date_format(day, "yyyy-MM-dd").alias("effective_date"), source.alias("date_source"), sure.alias("date_confidence"),
    )
    return pages.select("file", metadata.alias("metadata"), F.struct("source_file", F.struct("raw_text").alias("data")).alias("content"))


def titles(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks with their document's title, "Unknown Document" where there is none."""
    t = documents.select("doc_id", F.col("title").alias("doc_title"))
    return chunks.join(t, "doc_id", "left").na.fill("Unknown Document", ["doc_title"])


def merge_sections(pages: DataFrame) -> DataFrame:
    """(doc_id, sections): the pages' section lists in page order, each with its page; items without a heading or text go."""
    s = pages.select("doc_id", "page", F.posexplode("sections").alias("nth", "s")).filter("s.heading is not null and s.text is not null")
    g = s.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "nth", "s.heading", "s.text"))).alias("all"))
    return g.select("doc_id", F.transform("all", lambda x: F.struct(x["heading"].alias("heading"), x["text"].alias("text"), x["page"].alias("page_start"))).alias("sections"))


def ocr_blank(pages: DataFrame, factory: Factory, enabled: bool = True, calls: Calls | None = None) -> DataFrame:
    """Pages whose text is blank get it from the OCR model (asked with the page's image reference); the others pass."""
    blank = strip(F.coalesce("text", F.lit(""))) == ""
    if not enabled:
        return pages
    read = call_model(pages.filter(blank), "image", factory, calls=calls)
    return pages.filter(~blank).unionByName(read.withColumn("text", F.coalesce("answer", F.lit(""))).select(pages.columns))


def first_label(c: Column) -> Column:
    """A label that is a string or an array of strings in JSON: the string, or the array's first element."""
    return F.coalesce(F.get(F.from_json(c, "array<string>"), F.lit(0)), F.when(~c.startswith("["), F.regexp_replace(c, '^"|"$', "")))


def mime_split(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with their MIME type, quarantine) by extension."""
    kind = F.try_element_at(F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv]), F.col("ext"))
    t = files.withColumn("mime", kind)
    return t.filter("mime is not null"), t.filter("mime is null").drop("mime")


def element_ids(blocks: DataFrame) -> DataFrame:
    """Adds element_id: p<page>-b<n> for text and p<page>-t<n> for tables, each counted from 0 on its page. blocks: doc_id, page, ord, block_type."""
    n = F.row_number().over(Window.partitionBy("doc_id", "page", "block_type").orderBy("ord")) - 1
    mark = F.when(F.col("block_type") == "table", "t").otherwise("b")
    return blocks.withColumn("element_id", F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("-"), mark, n.cast("string")))


def span_ids(spans: DataFrame) -> DataFrame:
    """Adds span_id: <element_id>-s<n>, counted from 0 on each line of a block, so an id may come again on the block's next line. spans: doc_id, element_id, line, ord."""
    n = F.row_number().over(Window.partitionBy("doc_id", "element_id", "line").orderBy("ord")) - 1
    return spans.withColumn("span_id", F.concat("element_id", F.lit("-s"), n.cast("string")))

"""Reconciled documents: metadata of a document with its tables and enriched chunks as one nested record, and the checks a loader makes on such records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import docid_date, iso_or_default
from ..functions.jsonx import is_json

#: Names of the artifacts, the kind of chunk that a table's content goes to, and what is said of a record of another shape.
SOURCE_FILES = {"master_record": "master_record.json", "enriched_chunks": "enriched_chunks_v5.json"}
TABLE_CHUNK = "table_summary"
KEYS = ("document_level_metadata", "chunks")
MALFORMED = "Missing 'document_level_metadata' or 'chunks' keys."

TABLES = "array<struct<table_id:string,page_number:int,markdown_representation:string,llm_summary:string>>"


def document_level(doc_id: Column, tables: Column) -> Column:
    """A document's metadata: its publication date by its id, in ISO form, where that came from, the artifacts, its tables."""
    day, source = docid_date(doc_id)
    files = F.struct(*[F.lit(v).alias(k) for k, v in SOURCE_FILES.items()])
    return F.struct(doc_id.alias("doc_id"), F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss").alias("publication_date"), source.alias("date_source"), files.alias("source_files"), F.coalesce(tables, F.array().cast(TABLES)).alias("tables"))


def with_contents(chunks: Column, tables: Column) -> Column:
    """Chunks of tables with the markdown of their document's table of that id; where there is none, what they had. Of tables with one id the last counts."""
    named = F.filter(tables, lambda t: t["table_id"].isNotNull() & t["markdown_representation"].isNotNull())
    of = lambda c: F.element_at(F.concat(F.array(c["raw_table_content"]), F.transform(F.filter(named, lambda t: t["table_id"] == c["table_id"]), lambda t: t["markdown_representation"])), -1)
    return F.transform(chunks, lambda c: F.when((c["chunk_type"] == TABLE_CHUNK) & c["table_id"].isNotNull(), c.withField("raw_table_content", of(c))).otherwise(c))


def parts(chunks: Column, per_part: int) -> Column:
    """An array of chunks cut into arrays of at most per_part; an empty or null one is one empty part."""
    n = F.greatest(F.ceil(F.coalesce(F.size(chunks), F.lit(0)) / per_part), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(chunks, i * per_part + 1, F.lit(per_part)))


def assemble(masters: DataFrame, chunks: DataFrame, tables: DataFrame, per_part: int = 1000) -> DataFrame:
    """(doc_id, part, n_parts, document_level_metadata, chunks): every document of masters with its tables and chunks; a document of over per_part chunks is several records.

    masters: doc_id; chunks: doc_id, chunk_no (from 0), chunk_type, table_id, raw_table_content, ...; tables: doc_id, ord, table_id, page_number, markdown_representation, llm_summary.
    No group is larger than a part: a huge document's chunks are grouped part by part. Documents without a chunk are one record with none; chunks and tables of no
    master go. A table's content is looked up in the record itself, so chunks without a table meet no join key.
    """
    cols = [c for c in chunks.columns if c not in ("doc_id", "chunk_no")]
    grouped = chunks.groupBy("doc_id", F.floor(F.col("chunk_no") / per_part).cast("int").alias("part")).agg(F.array_sort(F.collect_list(F.struct("chunk_no", *cols))).alias("chunks"))
    kept = F.array_sort(F.collect_list(F.struct("ord", F.struct(F.col("table_id").cast("string").alias("table_id"), F.col("page_number").cast("int").alias("page_number"), "markdown_representation", "llm_summary").alias("t"))))
    listed = tables.groupBy("doc_id").agg(F.transform(kept, lambda x: x["t"]).alias("tables"))
    out = masters.select("doc_id").join(listed, "doc_id", "left").join(grouped, "doc_id", "left")
    none = F.array().cast(grouped.schema["chunks"].dataType)
    n_parts = F.coalesce(F.max("part").over(Window.partitionBy("doc_id")), F.lit(0)) + 1
    filled = with_contents(F.coalesce("chunks", none), F.coalesce("tables", F.array().cast(TABLES)))
    return out.select("doc_id", F.coalesce("part", F.lit(0)).alias("part"), n_parts.alias("n_parts"), document_level(F.col("doc_id").cast("string"), F.col("tables")).alias("document_level_metadata"), filled.alias("chunks"))


def shape_errors(raw: Column) -> Column:
    """What keeps a record in JSON from being loaded, or null: text that isn't JSON, a missing key, chunks that are no list."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    whole = F.forall(F.array(*map(F.lit, KEYS)), lambda k: F.array_contains(keys, k))
    chunks = F.try_variant_get(F.try_parse_json(raw), "$.chunks", "array<variant>")
    return F.when(~F.coalesce(is_json(raw), F.lit(False)), "not JSON").when(~whole, MALFORMED).when(chunks.isNull(), "'chunks' is no list")


def load_records(lines: DataFrame, column: str, chunk: str) -> tuple[DataFrame, DataFrame]:
    """(records: the other columns, doc_id, published, date_source, chunks; quarantine: the other columns, error, the text) of records in JSON. chunk: the DDL of a chunk's struct.

    A date that can't be read is 1970-01-01, a source that is missing 'unknown'.
    """
    rest = [c for c in lines.columns if c != column]
    judged = lines.withColumn("__error", shape_errors(F.col(column)))
    kind = f"document_level_metadata struct<doc_id:string,publication_date:string,date_source:string,tables:{TABLES}>, chunks array<{chunk}>"
    r = judged.filter("__error is null").withColumn("__r", F.from_json(column, kind))
    meta = F.col("__r.document_level_metadata")
    chunks = with_contents(F.col("__r.chunks"), F.coalesce(meta["tables"], F.array().cast(TABLES)))
    good = r.select(*rest, meta["doc_id"].alias("doc_id"), iso_or_default(F.coalesce(meta["publication_date"], F.lit(""))).alias("published"), F.coalesce(meta["date_source"], F.lit("unknown")).alias("date_source"), chunks.alias("chunks"))
    return good, judged.filter("__error is not null").select(*rest, F.col("__error").alias("error"), column)

"""Publish documents as reconciled records for the loader: metadata with the publication date, and chunks, in JSON by status and language; incomplete ones apart.

    python -m jobs.publish_records --source DIR --out DIR [--config FILE]

Writes `out`/records/status=<status>/lang=<language> (one JSON line a record: doc_id, name, title, part, n_parts, n_chunks, document_level_metadata, chunks), where the
status is published or the reason for quarantine, and `out`/summary, a CSV of documents and chunks by language and status. Both are replaced as a whole, so a
second run over the same input gives the same. Text stays in its document's row from the scan to the file, and is read once: nothing is shuffled but the summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs import common
from lamina.functions.text import normalize_text, title_guess
from lamina.operators.records import TABLES, document_level, parts
from lamina.plans.ingestion import packed_chunks

LOG = common.log("publish_records")
PUBLISHED, NO_TEXT, INCOMPLETE = "published", "no text", "incomplete"


def judged(docs: DataFrame, config: dict) -> DataFrame:
    """Documents with name, title, chunks, and status by the share of the cleaned text's characters, blanks apart, that chunks hold.

    docs: doc_id, text, lang, source. A document's name is <source>-<doc_id>, where its date is looked for.
    """
    solid = lambda c: F.length(F.regexp_replace(c, r"\s+", ""))
    chunks = packed_chunks(F.col("text"), F.col("doc_id"), config["chunk_size"], config["overlap"])
    d = docs.select("doc_id", "lang", F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("name"), title_guess(F.coalesce("text", F.lit(""))).alias("title"), solid(normalize_text(F.coalesce("text", F.lit("")))).alias("source_chars"), chunks.alias("chunks"))
    held = F.aggregate("chunks", F.lit(0), lambda n, c: n + solid(c["text"]))
    short = F.try_divide(held, F.col("source_chars")) < config["completeness"]
    return d.withColumn("status", F.when(F.col("source_chars") == 0, NO_TEXT).when(short, INCOMPLETE).otherwise(PUBLISHED))


def records(docs: DataFrame, config: dict) -> DataFrame:
    """A row for each part of each document of judged(): its metadata, and at most per_part chunks."""
    n = config["per_part"]
    cut = docs.select("*", F.posexplode(parts(F.col("chunks"), n)).alias("part", "mine"))
    chunk = lambda c: F.struct(c["chunk_id"].alias("chunk_id"), c["text"].alias("text"), F.lit("semantic_text").alias("chunk_type"), c["nth"].alias("chunk_no"), c["low_value"].alias("low_value"))
    whole = F.size("chunks").alias("n_chunks")
    n_parts = F.greatest(F.ceil(F.size("chunks") / n), F.lit(1)).cast("int").alias("n_parts")
    meta = document_level(F.col("name"), F.array().cast(TABLES)).alias("document_level_metadata")
    return cut.select("status", "lang", "doc_id", "name", "title", "part", n_parts, whole, meta, F.transform("mine", chunk).alias("chunks"))


def _counted(df: DataFrame, **what: Column) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[c.alias(k) for k, c in what.items()]), seen


def run(spark: SparkSession, source: str, out: str, config: dict | None = None) -> None:
    """All documents of `source`, Parquet files with doc_id, text, lang and source; other columns aren't read."""
    config = config or common.settings(__file__)
    docs, read = _counted(spark.read.parquet(source).select("doc_id", "text", "lang", "source"), n=F.count("*"))
    rows, written = _counted(records(judged(docs, config), config), n=F.count("*"), chunks=F.sum(F.size("chunks")), apart=F.count_if((F.col("status") != PUBLISHED) & (F.col("part") == 0)))
    rows.write.partitionBy("status", "lang").mode("overwrite").json(f"{out}/records")
    LOG.info("%d documents read from %s; %d records with %d chunks written to %s, %d documents not published", read.get["n"], source, written.get["n"], written.get["chunks"] or 0, f"{out}/records", written.get["apart"])
    sums = written_records(spark, out).groupBy("lang", "status").agg(F.count_if(F.col("part") == 0).alias("documents"), F.sum(F.when(F.col("part") == 0, F.col("n_chunks")).otherwise(0)).alias("chunks"))
    sums.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{out}/summary")
    LOG.info("summary written to %s", f"{out}/summary")


def written_records(spark: SparkSession, out: str) -> DataFrame:
    """What a run wrote; of status published, or in quarantine."""
    chunk = "struct<chunk_id:string,text:string,chunk_type:string,chunk_no:int,low_value:boolean>"
    meta = f"struct<doc_id:string,publication_date:string,date_source:string,source_files:struct<master_record:string,enriched_chunks:string>,tables:{TABLES}>"
    return spark.read.schema(f"doc_id long, name string, title string, part int, n_parts int, n_chunks int, document_level_metadata {meta}, chunks array<{chunk}>, status string, lang string").json(f"{out}/records")


if __name__ == "__main__":
    common.main(__file__, __doc__, run, ("source", "out"))

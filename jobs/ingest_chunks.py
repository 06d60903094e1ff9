"""Ingest new documents as chunks: a file stream over a folder of document tables, cleaned, packed and flagged, each version of a document once.

    python -m jobs.ingest_chunks --source DIR --out DIR --checkpoint DIR [--config FILE]

A run takes the files that came since the last one and ends. The stream's checkpoint knows which files were read and, by document and
digest of its text, which versions were ingested, so a document that is delivered again in another file makes no chunk. A micro-batch writes the partitions
batch=<number>/lang=<language> of `out` and no others, and replaces them when it is repeated after a failure. A changed text is a new version;
current() reads, of each document, the version of the latest batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs import common
from lamina.plans.ingestion import packed_chunks

SCHEMA = "doc_id long, text string, lang string"
LOG = common.log("ingest_chunks")


def chunked(docs: DataFrame, config: dict) -> DataFrame:
    """A row for each chunk (doc_id, lang, digest, nth, chunk_id, text, n_chars, low_value); a version without a chunk has one row whose nth is null, so that it replaces earlier ones."""
    chunks = packed_chunks(F.col("text"), F.col("doc_id"), config["chunk_size"], config["overlap"])
    return docs.select("doc_id", "lang", "digest", F.explode_outer(chunks).alias("c")).select("doc_id", "lang", "digest", "c.*")


def run(spark: SparkSession, source: str, out: str, checkpoint: str, config: dict | None = None) -> None:
    """Everything new in `source`, a folder of Parquet files, or a glob, with doc_id, text and lang; other columns aren't read. (A stream takes a single file as a glob only: /in/{one.parquet}.)"""
    config = config or common.settings(__file__)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", config["max_files"]).parquet(source)
    # a text's digest stands for it in the state; null and empty texts are one version
    fresh = stream.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)).dropDuplicates(["doc_id", "digest"])

    def write(batch: DataFrame, number: int) -> None:
        docs, made = Observation(), Observation()
        seen = batch.observe(docs, F.count("*").alias("documents"))
        rows = chunked(seen, config).observe(made, F.count("nth").alias("chunks"), F.count_if("low_value").alias("low"))
        rows = rows.withColumn("batch", F.lit(number).cast("long"))
        rows.write.partitionBy("batch", "lang").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(out)
        LOG.info("batch %d: %d new documents of %s, %d chunks (%d of low value) to %s", number, docs.get["documents"], source, made.get["chunks"], made.get["low"], out)

    with common.session_settings(spark, {"spark.sql.streaming.stateStore.providerClass": config["state_store"]}):
        query = fresh.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    if not query.recentProgress or not sum(p["numInputRows"] for p in query.recentProgress):
        LOG.info("nothing new in %s", source)


def current(spark: SparkSession, out: str) -> DataFrame:
    """The chunks of each document's latest version: of the latest batch; of several versions in one batch, that of the greatest digest."""
    rows = spark.read.schema("doc_id long, digest string, nth int, chunk_id string, text string, n_chars int, low_value boolean, batch long, lang string").parquet(out)
    latest = rows.groupBy("doc_id").agg(F.max(F.struct("batch", "digest")).alias("v")).select(F.col("doc_id").alias("id"), F.col("v.batch").alias("b"), F.col("v.digest").alias("d"))
    same = rows["doc_id"].eqNullSafe(latest["id"]) & (rows["batch"] == latest["b"]) & (rows["digest"] == latest["d"])
    return rows.filter("nth is not null").join(latest, same, "left_semi").drop("batch", "digest")


if __name__ == "__main__":
    common.main(__file__, __doc__, run, ("source", "out", "checkpoint"))

"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next stage's
docs. All but the last return the columns of documents: doc_id, text, lang, source, n_chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import line_dedup, mixing, packing, quality, simhash
from lamina.llm.common import drop_all_but, row_key, spill, spilled
from lamina.llm.queries import tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the robust outlier rule rejects go; the others stay as they are.

    Null and empty texts go (no words); rows that repeat are judged alike; nulls in lang and source are values; an empty table stays empty; texts of any length count whole.
    """
    return quality.judge(docs, COLUMNS).filter("kept").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of passages, of runs of lines of 50 words together too, go from the texts; documents of which nothing with a word is left go too."""
    out = line_dedup.dedup_lines(docs, ["doc_id", "lang", "source"], short_runs=True)
    out = out.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays; of rows that repeat it, one.

    Near copies: SimHash fingerprints of 5-word shingles that differ in 4 bits at most (the grid of segment popcounts, as in op6), and, where fingerprints are
    farther apart, sets of these shingles with a Jaccard similarity of 0.8 at least.
    A row without a doc_id stays only where its group has none, one for each group. Of rows with one doc_id the one
    whose columns have the smallest digest stays, so the order of rows doesn't matter.
    """
    key = row_key(*COLUMNS).alias("__key")
    out = simhash.similar_texts(docs.select("doc_id", "text", key), ["doc_id", "__key"], distance=4)
    first = out.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__key")).alias("first"))
    first = spill(first.select(F.col("first.__key").alias("__key")), "pipeline-first")
    # texts move once, by the key; the rows of a key are then together
    return docs.withColumn("__key", key).join(first.hint("merge"), "__key").dropDuplicates(["__key"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most one of a source in part; doc_id may repeat.

    A null source is one of its own; a null text has no words and is taken as often as others; ties in the order stand by id; an empty table stays empty.
    """
    return mixing.mixed_documents(docs, COLUMNS).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all texts in sequences of at most 1024 tokens; a null or empty text is its end token, rows that repeat are packed each, an empty table gives no piece."""
    return packing.pack(docs, tokenizer_file(), ["doc_id", "lang", "source"])


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: None: SQL can't express the robust estimates, fingerprints, token ids and configurations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; what a stage wrote for itself goes when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    others = spilled(spark)
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_all_but(spark, [*others, docs._lamina_path])
    return STAGES[-1][1](spark, docs, sf_dir)

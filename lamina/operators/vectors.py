"""Vectors: flat metadata, table content, several vectors for a chunk, upserts, statistics, exact nearest neighbours."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .calls import Asker, Call, Calls, side_by_side
from .enrich import PROMPTS
from .quality import PERSONAS

#: Kinds of vectors beside the base.
ASPECTS = ("clinical", "economic")


def persona_names(chunks: DataFrame, most: int = 100) -> list[str]:
    """The personas that occur in metadata, in order: columns need names before a plan runs. More than `most` are an error, as no schema has so many."""
    names = [r.p for r in chunks.select(F.explode(F.map_keys("metadata.persona_relevance_scores")).alias("p")).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"over {most} personas")
    return sorted(names)


def flatten_metadata(chunks: DataFrame, personas=PERSONAS) -> DataFrame:
    """One flat row for each enriched chunk (chunk_id, text, metadata struct, published timestamp), with defaults for what is missing and a
    column for each persona (see persona_names())."""
    m = lambda x: F.col(f"metadata.{x}")
    persona = {f"persona_{p}_score": F.try_element_at(m("persona_relevance_scores"), F.lit(p))["score"] for p in personas}
    levels = {f"section_level_{i + 1}": F.get(m("section_path"), F.lit(i)) for i in range(5)}
    names = F.transform(F.filter(m("typed_entities"), lambda e: e["name"].isNotNull()), lambda e: e["name"])
    return chunks.select(
        F.coalesce(m("doc_id"), F.lit("unknown_doc")).alias("doc_id"),
        "chunk_id",
        F.col("text").alias("text_for_embedding"),
        F.when(m("chunk_type") == "table_summary", m("raw_table_content")).otherwise(F.col("text")).alias("source_content"),
        F.coalesce(m("semantic_purpose.value"), F.lit("Unknown")).alias("semantic_purpose"),
        F.coalesce(m("semantic_purpose.confidence"), F.lit(0.0)).alias("semantic_purpose_confidence"),
        F.coalesce(m("quality_assessment.confidence"), F.lit(0.0)).alias("quality_assessment_confidence"),
        F.coalesce(m("quality_assessment.is_ambiguous"), F.lit(True)).alias("quality_assessment_is_ambiguous"),
        *[v.alias(k) for k, v in persona.items()],
        F.unix_timestamp("published").alias("published_timestamp"),
        F.array_join(F.coalesce(m("section_path"), F.array().cast("array<string>")), " > ").alias("section_path"),
        *[v.alias(k) for k, v in levels.items()],
        F.coalesce(names, F.array().cast("array<string>")).alias("mentioned_entities"),
    )


def table_lookup(chunks: DataFrame, tables: DataFrame) -> DataFrame:
    """Table chunks with the table's text by (doc_id, table_id); what a chunk has stays where no table is found."""
    t = tables.select("doc_id", "table_id", F.col("markdown").alias("__md"))
    j = chunks.join(t, ["doc_id", "table_id"], "left")
    return j.withColumn("raw_table_content", F.coalesce("__md", "raw_table_content")).drop("__md")


def embedding_text(doc_id: Column, path: Column, purpose: Column, text: Column) -> Column:
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit("DOCUMENT: "), blank(doc_id), F.lit("\nSECTION: "), blank(path), F.lit("\nTYPE: "), blank(purpose), F.lit("\nCONTENT: "), blank(text))


def multi_vectors(chunks: DataFrame) -> DataFrame:
    """A row for each vector to make: base always, clinical and economic where their summary isn't blank. Ids are chunk::type."""
    kinds = F.array(*[F.struct(F.lit(k).alias("vector_type"), F.col(c).alias("input")) for k, c in (("base", "base_text"), ("clinical", "clinical_summary"), ("economic", "economic_summary"))])
    out = chunks.select("chunk_id", "doc_id", F.explode(kinds).alias("v")).select("chunk_id", "doc_id", "v.*")
    out = out.filter((F.col("vector_type") == "base") | (F.trim(F.coalesce("input", F.lit(""))) != ""))
    return out.select(F.concat_ws("::", "chunk_id", "vector_type").alias("id"), F.col("doc_id").alias("namespace"), "vector_type", "input")


def aspect_prompt(text: str) -> str:
    return PROMPTS["aspect_summaries"].replace("{text}", text)


def summaries_of(answer: str) -> dict[str, str]:
    """Both summaries of a model's answer; anything but JSON with two texts is an error."""
    got = json.loads(answer)
    if not isinstance(got, dict) or not all(isinstance(got.get(f"{a}_summary"), str) for a in ASPECTS):
        raise ValueError("summaries are missing")
    return {a: got[f"{a}_summary"] for a in ASPECTS}


def vector_payload(chunks: DataFrame, embedder: Callable[[], Callable[[str], list[float]]], summarizer: Callable[[], Callable[[str], str]], calls: Calls | None = None) -> DataFrame:
    """(id, namespace, vector_type, values) of chunks (chunk_id, doc_id, section_path, purpose, text): the base vector of the chunk's template, and one for each aspect.

    A chunk whose base vector fails has no vectors at all, and its summaries are not asked for. Where the summaries fail or are blank, or an
    aspect's vector fails, that vector alone is missing. One pass, so that no model is asked twice; chunks are worked on side by side, and
    every call is tried again, by the rules of `calls`; a chunk that waits for its next try holds up no other.
    """
    calls = calls or Calls()
    text = embedding_text(F.col("doc_id").cast("string"), F.array_join("section_path", " > "), F.col("purpose"), F.col("text"))
    src = chunks.select(F.col("chunk_id").cast("string").alias("chunk_id"), F.col("doc_id").cast("string").alias("doc_id"), text.alias("base"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = Asker(lambda: (lambda model: lambda t: [float(x) for x in model(t)])(embedder()), calls)
        summarise = Asker(lambda: (lambda model: lambda t: summaries_of(model(aspect_prompt(t))))(summarizer()), calls)

        async def vectors(row: tuple, call: Call) -> list[tuple]:
            chunk, doc, base, own = row
            vector, _ = await embed.later(base, call)  # a missing vector is retried by the next run
            if vector is None:
                return []
            said = (await summarise.later(own, call))[0] or {}
            more = [(aspect, (await embed.later(said[aspect], call))[0]) for aspect in ASPECTS if said.get(aspect, "").strip()]
            return [(f"{chunk}::{kind}", doc, kind, v) for kind, v in (("base", vector), *more) if v is not None]

        names = ["id", "namespace", "vector_type", "values"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.float64())]
        rows = ((b, list(zip(*(c.to_pylist() for c in b.columns), strict=True))) for b in batches)
        for _, made in side_by_side(rows, vectors, calls.concurrency):
            flat = [v for found in made for v in found]
            yield pa.RecordBatch.from_arrays([pa.array([v[i] for v in flat], k) for i, k in enumerate(kinds)], names)

    return src.mapInArrow(run, "id string, namespace string, vector_type string, values array<double>")


def page_vectors(docs: DataFrame) -> DataFrame:
    """Vectors of processed documents: pages and chunks unnested, chunks without an embedding left out."""
    p = docs.select("document_id", "source_file", F.explode("pages").alias("p"))
    c = p.select("document_id", "source_file", "p.page_number", F.col("p.page_metadata.summary").alias("page_summary"), F.col("p.page_metadata.content_type").alias("page_content_type"), F.explode("p.chunks").alias("c"))
    return c.filter(F.size("c.embedding") > 0).select(F.col("c.chunk_id").alias("id"), F.col("c.embedding").alias("values"), "document_id", "source_file", "page_number", F.col("c.chunk_type").alias("chunk_type"), "page_summary", "page_content_type", F.col("c.text").alias("text"))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key has no update, and the updates; the last of several updates (by `version`) wins, of several of one version that of the greatest digest of its columns."""
    w = Window.partitionBy(*keys).orderBy(F.desc("version"), F.desc(F.sha2(F.to_json(F.struct(*updates.columns)), 256)))
    last = updates.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
    return target.join(last.select(*keys), keys, "left_anti").unionByName(last)


def embedding_stats(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(total, failed, mean_dims): failed are empty or null; the mean is over the others, 0 without any."""
    n = F.coalesce(F.size(column), F.lit(0))
    n = F.greatest(n, F.lit(0))
    return vectors.agg(F.count("*").alias("total"), F.count_if(n == 0).alias("failed"), F.coalesce(F.avg(F.when(n > 0, n)), F.lit(0.0)).alias("mean_dims"))


def index_stats(vectors: DataFrame) -> DataFrame:
    """Vectors of each namespace, and of all as namespace null."""
    return vectors.rollup("namespace").agg(F.count("*").alias("n"))


def sound(embedding: str = "embedding") -> Column:
    """Whether a vector has a direction: it isn't null or zero, and holds no null or non-finite part."""
    return F.coalesce(F.exists(embedding, lambda v: v != 0) & ~F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False))


def _best(k: int) -> Callable[[pa.Table], pa.Table]:
    """For a table of queries (side 0) and vectors (side 1): the k best vectors of each query, cosines to six places, ties by smaller id; not the query itself."""
    def best(t: pa.Table) -> pa.Table:
        side, ids = t.column("side").to_numpy(), t.column("id").to_numpy(zero_copy_only=False)
        x = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
        asks, found = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out: list[list] = [[], [], []]
        for at in range(0, len(asks), 256):
            part = asks[at : at + 256]
            c = np.floor(x[part] @ x[found].T * 1e6 + 0.5) / 1e6
            c[ids[part][:, None] == ids[found]] = -2
            least = -np.partition(-c, min(k, len(found)) - 1, axis=1)[:, min(k, len(found)) - 1] if len(found) else np.zeros(len(part))
            for r, i in enumerate(part):
                near = np.flatnonzero((c[r] >= least[r]) & (c[r] > -2))
                near = near[np.lexsort((ids[found[near]], -c[r, near]))][:k]
                for o, y in zip(out, ([ids[i]] * len(near), ids[found[near]].tolist(), c[r, near].tolist()), strict=True):
                    o.extend(y)
        return pa.table({"query_id": pa.array(out[0], t.schema.field("id").type), "vec_id": pa.array(out[1], t.schema.field("id").type), "cosine": pa.array(out[2], pa.float64())})

    return best


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


def _taken(df: DataFrame, side: int) -> DataFrame:
    return df.filter(sound()).select(F.lit(side).alias("side"), F.col("vec_id").alias("id"), F.size("embedding").alias("dims"), F.col("embedding").cast("array<double>").alias("v"))


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int, block: int = 16_384) -> DataFrame:
    """The k nearest by cosine for each query, exactly: (query_id, vec_id, rank, cosine), cosines to six places. Ties go to the smaller id; a vector
    isn't its own neighbour. Vectors that are null, zero or hold null or non-finite parts neither ask nor answer; lengths are apart.

    A stated set of queries against all rows: queries and vectors are dealt into blocks of about `block`, and each pair of blocks is a
    task of bounded size, one product of matrices; it returns the k best of its block for each of its queries, and the best of those are
    the result. Nothing is broadcast, and no row for a pair of vectors leaves a task.
    """
    q, v = _taken(queries, 0), _taken(vectors, 1)
    nq, nv = (max(1, -(-df.count() // block)) for df in (q, v))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    both = q.withColumn("a", deal(nq)).withColumn("b", every(nv)).unionByName(v.withColumn("b", deal(nv)).withColumn("a", every(nq)))
    id_type = both.schema["id"].dataType.simpleString()
    return _ranked(both.groupBy("dims", "a", "b").applyInArrow(_best(k), f"query_id {id_type}, vec_id {id_type}, cosine double"), k)


def batches(df: DataFrame, order: list[str], size: int = 100) -> DataFrame:
    """Adds batch: number of the block of `size` rows of a namespace, in order; namespaces are batched apart, so no sort is over all rows."""
    n = F.row_number().over(Window.partitionBy("namespace").orderBy(*order))
    return df.withColumn("batch", F.floor((n - 1) / size).cast("int"))

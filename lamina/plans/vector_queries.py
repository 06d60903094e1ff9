"""Queries of vectors, star-schema extras and event windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ann as A
from ..operators import vectors as V
from ..operators.enrich import PROMPTS
from .registry import query, table

_PURPOSE = "['Efficacy Results', 'Miscellaneous', 'Regulatory History']"


def enriched(spark, d):
    """Documents as enriched chunks."""
    meta = F.expr("""named_struct('doc_id', CASE WHEN doc_id % 9 = 0 THEN NULL ELSE source END, 'chunk_type', CASE WHEN doc_id % 4 = 0 THEN 'table_summary' ELSE 'efficacy_results' END,
      'section_path', array(source, lang), 'raw_table_content', concat('|', doc_id, '|'),
      'semantic_purpose', CASE WHEN doc_id % 5 > 0 THEN named_struct('value', 'Efficacy Results', 'confidence', 0.25, 'justification', 'j') END,
      'persona_relevance_scores', map('clinical_analyst', named_struct('score', doc_id / 1000.0D, 'justification', 'j')),
      'typed_entities', array(named_struct('name', lang, 'type', 'DRUG'), named_struct('name', cast(NULL AS string), 'type', 'DRUG')),
      'quality_assessment', CASE WHEN doc_id % 2 = 0 THEN named_struct('confidence', 0.75, 'is_ambiguous', false, 'justification', 'j') END)""")
    return table(spark, d, "documents").select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("chunk_id"), "text", meta.alias("metadata"), F.lit("2024-11-01 00:00:00").cast("timestamp").alias("published"))


@query("flatten_metadata", """
SELECT 'c' || doc_id AS chunk_id, CASE WHEN doc_id % 9 = 0 THEN 'unknown_doc' ELSE source END AS doc_id, md5(text) AS text_md5, md5(CASE WHEN doc_id % 4 = 0 THEN '|' || doc_id || '|' ELSE text END) AS source_md5,
 CASE WHEN doc_id % 5 > 0 THEN 'Efficacy Results' ELSE 'Unknown' END AS semantic_purpose, CASE WHEN doc_id % 5 > 0 THEN 0.25 ELSE 0.0 END::DOUBLE AS semantic_purpose_confidence,
 CASE WHEN doc_id % 2 = 0 THEN 0.75 ELSE 0.0 END::DOUBLE AS quality_assessment_confidence, doc_id % 2 = 1 AS quality_assessment_is_ambiguous, doc_id / 1000.0 AS persona_clinical_analyst_score, NULL::DOUBLE AS persona_health_economist_score,
 epoch(TIMESTAMP '2024-11-01')::BIGINT AS published_timestamp, source || ' > ' || lang AS section_path, source AS section_level_1, lang AS section_level_2, NULL::VARCHAR AS section_level_3, lang AS mentioned_entities FROM documents""")
def flatten(spark, d):
    f = V.flatten_metadata(enriched(spark, d))
    names = ["chunk_id", "doc_id", "semantic_purpose", "semantic_purpose_confidence", "quality_assessment_confidence", "quality_assessment_is_ambiguous", "persona_clinical_analyst_score", "persona_health_economist_score", "published_timestamp", "section_path", "section_level_1", "section_level_2", "section_level_3"]
    return f.select(*names, F.md5("text_for_embedding").alias("text_md5"), F.md5("source_content").alias("source_md5"), F.array_join("mentioned_entities", ",").alias("mentioned_entities"))


@query("table_lookup_join", "SELECT l_orderkey, l_linenumber, coalesce(p_name, CASE WHEN l_linenumber = 1 THEN 'kept' END) AS content FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size < 40")
def lookup(spark, d):
    chunks = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.lit(1).alias("doc_id"), F.col("l_partkey").alias("table_id"), F.expr("CASE WHEN l_linenumber = 1 THEN 'kept' END").alias("raw_table_content"))
    tables = table(spark, d, "part").filter("p_size < 40").select(F.lit(1).alias("doc_id"), F.col("p_partkey").alias("table_id"), F.col("p_name").alias("markdown"))
    return V.table_lookup(chunks, tables).select("l_orderkey", "l_linenumber", F.col("raw_table_content").alias("content"))


@query("embedding_text", "SELECT doc_id, md5('DOCUMENT: ' || source || chr(10) || 'SECTION: ' || lang || ' > ' || source || chr(10) || 'TYPE: ' || chr(10) || 'CONTENT: ' || text) AS h FROM documents")
def emb_text(spark, d):
    t = V.embedding_text(F.col("source"), F.concat_ws(" > ", "lang", "source"), F.lit(None).cast("string"), F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(t).alias("h"))


@query("multi_vectors", """
WITH v AS (SELECT doc_id, unnest([{'t': 'base', 'i': text}, {'t': 'clinical', 'i': CASE WHEN lang = 'en' THEN source ELSE '  ' END}, {'t': 'economic', 'i': CASE WHEN n_chars > 2000 THEN lang END}]) AS v FROM documents)
SELECT doc_id || '::' || v.t AS id, doc_id::VARCHAR AS namespace, v.t AS vector_type FROM v WHERE v.t = 'base' OR trim(coalesce(v.i, '')) <> ''""")
def multi(spark, d):
    c = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("base_text"), F.expr("CASE WHEN lang = 'en' THEN source ELSE '  ' END").alias("clinical_summary"), F.expr("CASE WHEN n_chars > 2000 THEN lang END").alias("economic_summary"))
    return V.multi_vectors(c).select("id", "namespace", "vector_type")


def toy_embedder():
    """Two numbers of a text; an error for texts whose length is a multiple of 13."""
    def embed(text: str) -> list[float]:
        if len(text) % 13 == 0:
            raise ValueError("no vector")
        return [float(len(text)), 1.0]

    return embed


def toy_summarizer():
    """By the length of the prompt: an error, no JSON, a missing summary, one or two summaries."""
    def answer(prompt: str) -> str:
        n = len(prompt)
        if n % 6 == 0:
            raise TimeoutError("busy")
        return {1: "text", 2: '{"clinical_summary": "c"}', 3: '{"clinical_summary": "cc", "economic_summary": " "}', 4: '{"clinical_summary": "", "economic_summary": "eee"}', 5: '{"clinical_summary": "cc", "economic_summary": "thirteen long"}'}[n % 6]

    return answer


_ASPECT = len(PROMPTS["aspect_summaries"].replace("{text}", ""))


@query("vector_payload", f"""
WITH c AS (SELECT doc_id, length('DOCUMENT: ' || source || chr(10) || 'SECTION: ' || source || ' > ' || lang || chr(10) || 'TYPE: ' || chr(10) || 'CONTENT: ' || text) AS n, ({_ASPECT} + length(text)) % 6 AS k FROM documents)
SELECT 'c' || doc_id || '::' || v.t AS id, v.t AS vector_type, v.x AS x FROM (SELECT doc_id, unnest([{{'t': 'base', 'x': n::DOUBLE}}, {{'t': 'clinical', 'x': CASE WHEN k IN (3, 5) THEN 2.0::DOUBLE END}}, {{'t': 'economic', 'x': CASE WHEN k = 4 THEN 3.0::DOUBLE END}}]) AS v FROM c WHERE n % 13 > 0) WHERE v.x IS NOT NULL""")
def payload_vectors(spark, d):
    c = table(spark, d, "documents").select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("chunk_id"), F.col("source").alias("doc_id"), F.array("source", "lang").alias("section_path"), F.lit(None).cast("string").alias("purpose"), "text")
    return V.vector_payload(c, toy_embedder, toy_summarizer).select("id", "vector_type", F.get("values", F.lit(0)).alias("x"))


@query("persona_columns", "SELECT 'c' || doc_id AS chunk_id, doc_id / 1000.0 AS persona_clinical_analyst_score, CASE WHEN doc_id % 3 = 0 THEN 0.5 END::DOUBLE AS persona_patient_score FROM documents")
def persona_columns(spark, d):
    """Columns for the personas that occur, known ones or not."""
    e = enriched(spark, d)
    more = F.when(F.col("doc_id") % 3 == 0, F.map_concat("metadata.persona_relevance_scores", F.create_map(F.lit("patient"), F.struct(F.lit(0.5).alias("score"), F.lit("j").alias("justification"))))).otherwise(F.col("metadata.persona_relevance_scores"))
    e = e.withColumn("doc_id", F.substring("chunk_id", 2, 20).cast("long")).withColumn("metadata", F.col("metadata").withField("persona_relevance_scores", more)).drop("doc_id")
    f = V.flatten_metadata(e, V.persona_names(e))
    return f.select("chunk_id", *[c for c in f.columns if c.startswith("persona_")])


@query("page_vectors", "SELECT vec_id::VARCHAR AS id, label::VARCHAR AS document_id, (vec_id % 7 + 1)::INT AS page_number, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings WHERE vec_id % 5 > 0")
def page_vectors(spark, d):
    e = table(spark, d, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 5 > 0, F.col("embedding")).otherwise(F.array().cast("array<float>")))
    chunk = F.struct(F.col("vec_id").cast("string").alias("chunk_id"), F.lit("t").alias("text"), F.lit("text").alias("chunk_type"), "embedding")
    # a label's vectors in documents of 700 at most: a processed document is one row
    e = e.withColumn("part", F.expr("vec_id div 700"))
    p = e.groupBy("label", "part", (F.col("vec_id") % 7 + 1).cast("int").alias("page_number")).agg(F.collect_list(chunk).alias("chunks"))
    meta = F.struct(F.lit("s").alias("summary"), F.lit("ct").alias("content_type"))
    docs = p.groupBy(F.col("label").cast("string").alias("document_id"), "part").agg(F.collect_list(F.struct("page_number", meta.alias("page_metadata"), "chunks")).alias("pages")).withColumn("source_file", F.lit("f"))
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return V.page_vectors(docs).select("id", "document_id", "page_number", F.round(total, 4).alias("total"))


@query("vector_upsert", "SELECT vec_id AS id, CASE WHEN label < 3 THEN 2 ELSE 0 END AS version FROM embeddings UNION ALL SELECT vec_id + 1000000, 2 FROM embeddings WHERE label < 3")
def upsert(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label")
    changed = e.filter("label < 3").select("id")
    e = e.select("id")
    new = changed.unionByName(changed.select((F.col("id") + 1000000).alias("id")))
    updates = new.withColumn("version", F.lit(1)).unionByName(new.withColumn("version", F.lit(2)))
    return V.upsert(e.withColumn("version", F.lit(0)), updates, ["id"])


@query("embedding_stats", "SELECT count(*) AS total, count(*) FILTER (vec_id % 10 = 3) AS failed, 64.0::DOUBLE AS mean_dims FROM embeddings")
def emb_stats(spark, d):
    e = table(spark, d, "embeddings").select(F.when(F.col("vec_id") % 20 == 3, F.array().cast("array<float>")).when(F.col("vec_id") % 20 != 13, F.col("embedding")).alias("embedding"))
    return V.embedding_stats(e)


@query("index_stats", "SELECT label AS namespace, count(*) AS n FROM embeddings GROUP BY ROLLUP (label)")
def index(spark, d):
    return V.index_stats(table(spark, d, "embeddings").withColumnRenamed("label", "namespace"))


@query("cosine_topk", """
WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS cosine FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, vec_id, cosine, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id)::INT AS rank FROM s QUALIFY rank <= 10""")
def topk(spark, d):
    e = table(spark, d, "embeddings")
    return V.cosine_topk(e.filter("vec_id % 20 = 0"), e, 10)


@query("ann_topk", "SELECT vec_id AS query_id, 10 AS found, true AS good FROM embeddings WHERE vec_id % 20 = 0")
def ann_topk(spark, d):
    """Every twentieth vector against all of them through the index; good: at least 9 of 10 exact neighbours over all queries were found."""
    from .flow_queries import scratch

    e = table(spark, d, "embeddings")
    queries, path = e.filter("vec_id % 20 = 0"), f"{scratch(spark)}/cells"
    near = A.search(queries, path, A.build(e, path), 10)
    exact = V.cosine_topk(queries, e, 10).select("query_id", "vec_id", F.lit(1).alias("hit"))
    each = near.join(exact, ["query_id", "vec_id"], "left").groupBy("query_id").agg(F.count("*").cast("int").alias("found"), F.count("hit").alias("hits"))
    share = each.agg((F.sum("hits") / (F.count("*") * 10) >= 0.9).alias("good"))
    return each.join(F.broadcast(share)).select("query_id", "found", "good")  # one row


@query("batching", "SELECT vec_id, label AS namespace, ((row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 100)::INT AS batch FROM embeddings")
def batching(spark, d):
    return V.batches(table(spark, d, "embeddings").select("vec_id", F.col("label").alias("namespace")), ["vec_id"])


# extras of the engine


@query("event_windows", "SELECT event_type, strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = e.groupBy("event_type", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select("event_type", F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n", "total")


@query("event_sessions", """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS nth FROM g)
SELECT user_id, nth::BIGINT AS nth, count(*) AS n FROM s GROUP BY ALL""")
def event_sessions(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.lag(F.unix_micros(F.col("ts").cast("timestamp"))).over(w)
    e = table(spark, d, "events").withColumn("new", F.when(gap <= 30 * 60 * 1_000_000, 0).otherwise(1))
    e = e.withColumn("nth", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy("user_id", "nth").agg(F.count("*").alias("n"))


@query("revenue_by_region", """
SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def revenue(spark, d):
    t = lambda n: table(spark, d, n)
    j = t("lineitem").join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
    j = j.join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))

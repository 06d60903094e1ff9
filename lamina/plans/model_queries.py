"""Queries of the steps around models, with stand-ins for the models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models as M
from ..operators.calls import ONE_BY_ONE, Calls, answers, cached_call
from .registry import query, table
from .text_queries import strip_sql


def pages(spark, d):
    """Conversations as documents and their turns as pages; every fifth document's pages are blank."""
    return table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page"), F.expr("CASE WHEN conv_id % 5 = 0 THEN ' \n' ELSE text END").alias("text"))


def documents(spark, d):
    """The conversations, and as many documents without a page."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id")).distinct()
    return c.unionByName(c.select((-1 - F.col("doc_id")).alias("doc_id")))


_P = "p AS (SELECT conv_id AS doc_id, turn + 1 AS page, CASE WHEN conv_id % 5 = 0 THEN ' ' || chr(10) ELSE text END AS text FROM conversations), d AS (SELECT DISTINCT conv_id AS doc_id FROM conversations UNION ALL SELECT -1 - conv_id FROM (SELECT DISTINCT conv_id FROM conversations))"


@query("triage", f"WITH {_P}, m AS (SELECT doc_id, round(avg(length({strip_sql('text')})), 4) AS mean_chars FROM p WHERE page <= 5 GROUP BY doc_id) SELECT d.doc_id, mean_chars, CASE WHEN mean_chars IS NULL THEN 'empty_document' ELSE 'vector_analysis' END AS method, CASE WHEN mean_chars IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS confidence FROM d LEFT JOIN m ON m.doc_id = d.doc_id")
def triage(spark, d):
    return M.triage(documents(spark, d), pages(spark, d)).withColumn("mean_chars", F.round("mean_chars", 4))


@query("page_counts", "SELECT n_name AS doc_id, count(s_suppkey) AS n_pages FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def page_counts(spark, d):
    n = table(spark, d, "nation")
    p = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("doc_id"))
    return M.page_counts(n.select(F.col("n_name").alias("doc_id")), p)


@query("first_pages", f"WITH {_P} SELECT doc_id, md5(string_agg(text, chr(10) ORDER BY page)) AS h FROM p WHERE page <= 3 GROUP BY doc_id")
def first_pages(spark, d):
    return M.first_pages(pages(spark, d)).select("doc_id", F.md5("context").alias("h"))


def metadata_model():
    def answer(text: str) -> str:
        n = len(text)
        if n % 4 == 0:
            raise TimeoutError("busy")
        return "no json" if n % 4 == 1 else '```json\n{"doc_title": {"value": "%d", "confidence": 0.5, "justification": "j"}, "extra": 1}\n```' % n

    return answer


@query("global_metadata", f"""
WITH {_P}, c AS (SELECT doc_id, length('Extract metadata:' || chr(10) || string_agg(text, chr(10) ORDER BY page)) AS n FROM p WHERE page <= 3 GROUP BY doc_id)
SELECT doc_id, CASE WHEN n % 4 < 2 THEN 'Extraction Failed' ELSE n::VARCHAR END AS title, CASE WHEN n % 4 < 2 THEN 0.0 ELSE 0.5 END::DOUBLE AS confidence, CASE n % 4 WHEN 0 THEN 'TimeoutError: busy' WHEN 1 THEN 'not JSON' END AS error FROM c""")
def metadata(spark, d):
    m = M.global_metadata(pages(spark, d), metadata_model, calls=ONE_BY_ONE)
    return m.select("doc_id", F.col("metadata.doc_title.value").alias("title"), F.col("metadata.doc_title.confidence").alias("confidence"), "error")


def length_model():
    return lambda text: f"{len(text)} characters"


@query("table_summaries", "SELECT p_partkey AS table_id, CASE WHEN p_size > 25 THEN 'N/A (no table content)' ELSE (length(p_name) + length('Summarise this table:') + 1) || ' characters' END AS llm_summary FROM part")
def summaries(spark, d):
    t = table(spark, d, "part").select(F.lit("d").alias("doc_id"), F.col("p_partkey").alias("table_id"), F.expr("CASE WHEN p_size > 40 THEN NULL WHEN p_size > 25 THEN ' \n' ELSE p_name END").alias("markdown"))
    return M.table_summaries(t, length_model, calls=ONE_BY_ONE).select("table_id", "llm_summary")


#: The stand-in's vector: the first 8 bytes of the text's SHA-256, scaled to length 1.
_UNIT = "list_transform(range(0, 8), lambda i: ('0x' || substr(sha256(text), (2 * i + 1)::INT, 2))::INT)"


@query("embed_texts", f"WITH b AS (SELECT conv_id, turn, {strip_sql('text')} AS t, {_UNIT} AS bytes FROM conversations) SELECT conv_id, turn, CASE WHEN t = '' THEN '' ELSE array_to_string(list_transform(bytes, lambda x: round(x / greatest(sqrt(list_sum(list_transform(bytes, lambda y: y * y))), 1) * 1000000)::BIGINT), ',') END AS vector FROM b")
def embed(spark, d):
    e = M.embed(table(spark, d, "conversations").select("conv_id", "turn", "text"), "text", M.offline_embedder(), ONE_BY_ONE)
    return e.select("conv_id", "turn", F.array_join(F.transform("embedding", lambda x: F.round(x * 1_000_000).cast("long").cast("string")), ",").alias("vector"))


def class_model():
    return lambda text: '{"summary": "s", "tags": ["a"], "classification": "long"}' if len(text) >= 1500 else "short text"


@query("classify", "SELECT doc_id, CASE WHEN n_chars >= 1500 THEN 's' ELSE 'short text' END AS summary, CASE WHEN n_chars >= 1500 THEN 'long' ELSE 'manual_review_required' END AS classification FROM documents WHERE n_chars >= 100")
def classify(spark, d):
    return M.classify(table(spark, d, "documents"), class_model, calls=ONE_BY_ONE).select("doc_id", "summary", "classification")


@query("enrich_defaults", rf"""
SELECT doc_id, CASE WHEN quality = 1 THEN 'Q' || doc_id ELSE coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip_sql('x')}), lambda x: length(x) > 0 AND len(regexp_extract_all(x, '\S+')) <= 15)[1], 'Untitled Document') END AS title, CASE WHEN toxic IS NULL THEN 'Unknown' ELSE 'T' || toxic END AS doc_type FROM documents LEFT JOIN labels USING (doc_id)""")
def defaults(spark, d):
    x = table(spark, d, "labels").select("doc_id", F.expr("CASE WHEN quality = 1 THEN concat('Q', doc_id) END").alias("title"), F.concat(F.lit("T"), F.col("toxic").cast("string")).alias("doc_type"))
    return M.with_defaults(table(spark, d, "documents").select("doc_id", "text"), x).select("doc_id", "title", "doc_type")


@query("extraction_envelope", f"WITH {_P}, n AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id) SELECT d.doc_id, 'src' || d.doc_id AS source_file, coalesce(n, 0) AS page_count, CASE WHEN d.doc_id % 2 = 0 THEN 'T' || d.doc_id ELSE 'one line' END AS title, CASE WHEN d.doc_id % 2 = 0 THEN 'PSD' ELSE 'Unknown' END AS doc_type, true AS stamped FROM d LEFT JOIN n ON n.doc_id = d.doc_id")
def extraction(spark, d):
    docs = documents(spark, d).select("doc_id", F.concat(F.lit("src"), F.col("doc_id").cast("string")).alias("source"), F.lit("\none line").alias("text"))
    got = docs.filter("doc_id % 2 = 0").select("doc_id", F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), F.lit("PSD").alias("doc_type"))
    e = M.extraction_envelope(docs, got, pages(spark, d))
    return e.select("doc_id", "metadata.source_file", "metadata.page_count", "metadata.title", "metadata.doc_type", F.col("metadata.extracted_at").isNotNull().alias("stamped"))


def page_model():
    """Answers by the length of what it is shown: an error, text that isn't JSON, or fields and sections."""
    def answer(prompt: str) -> str:
        n = len(prompt)
        if n % 5 == 0:
            raise TimeoutError("busy")
        if n % 5 == 1:
            return "no json"
        return '{"title": "%s", "drug_name": "D%d", "page_sections": [{"heading": "H%d", "text": "t"}, {"heading": "no text"}]}' % ("" if n % 5 == 2 else f"T{n}", n, n)

    return answer


@query("extract_pages", f"""
WITH {_P}, n AS (SELECT doc_id, page, length('Text of page ' || page || ':' || chr(10) || text) AS n FROM p WHERE {strip_sql('text')} <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page) AS nth FROM n WHERE n % 5 > 1),
m AS (SELECT doc_id, 'T' || (arg_min(n, page) FILTER (n % 5 > 2)) AS title, 'D' || arg_min(n, page) AS drug_name, string_agg('H' || n || ':' || nth, ',' ORDER BY page) AS sections FROM r GROUP BY doc_id)
SELECT d.doc_id, title, drug_name, sections, CASE WHEN m.doc_id IS NULL THEN 'No data could be extracted from any page.' END AS error FROM d LEFT JOIN m ON m.doc_id = d.doc_id""")
def page_wise(spark, d):
    e = M.extract_pages(documents(spark, d), pages(spark, d), page_model, calls=ONE_BY_ONE)
    return e.select("doc_id", "title", "drug_name", F.array_join(F.transform("sections", lambda s: F.concat_ws(":", s["heading"], s["page_start"].cast("string"))), ",").alias("sections"), "error")


def document_model():
    def answer(prompt: str) -> str:
        n = len(prompt)
        if n % 3 == 0:
            raise TimeoutError("busy")
        return "nothing" if n % 3 == 1 else '```json\n{"title": "%d"}\n```' % n

    return answer


@query("extract_documents", """
WITH f AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.txt' ELSE '.xyz' END AS ext, length('Extract the fields of this document as JSON:') + 1 + length(text) AS n FROM documents)
SELECT '/in/' || doc_id || ext AS path, CASE WHEN ext <> '.xyz' AND n % 3 = 2 THEN n::VARCHAR END AS title, CASE WHEN ext = '.xyz' THEN 'Unsupported file type: .xyz' WHEN n % 3 = 0 THEN 'TimeoutError: busy' WHEN n % 3 = 1 THEN 'not JSON' END AS error FROM f""")
def whole_documents(spark, d):
    ext = F.expr("CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.txt' ELSE '.xyz' END")
    files = table(spark, d, "documents").select(F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), ext).alias("path"), ext.alias("ext"), "text")
    return M.extract_documents(files, document_model, "title string", ONE_BY_ONE).select("path", "fields.title", "error")


def summary_model():
    def answer(text: str) -> str:
        if len(text) % 7 == 0:
            raise TimeoutError("busy")
        return '{"summary": "%d", "tags": ["a"], "classification": "c"}' % len(text) if len(text) % 7 < 4 else "prose"

    return answer


@query("summarise", f"""
WITH s AS (SELECT doc_id, length({strip_sql('text')}) < 30 AS short, least(length(text), 4000) AS n FROM documents)
SELECT doc_id, CASE WHEN short OR n % 7 = 0 THEN '' WHEN n % 7 < 4 THEN n::VARCHAR ELSE 'prose' END AS summary, CASE WHEN short THEN 'n/a' WHEN n % 7 = 0 THEN 'gemini_error' WHEN n % 7 < 4 THEN 'c' ELSE 'manual_review_required' END AS classification FROM s""")
def summarised(spark, d):
    return M.summarise(table(spark, d, "documents"), summary_model, calls=ONE_BY_ONE).select("doc_id", "summary", "classification")


def type_model():
    def answer(text: str) -> str:
        if len(text) % 6 == 0:
            raise TimeoutError("busy")
        return '{"Document Type": "PSD", "document_type": ["PSD", "MISC"], "Topics": ["a", "b"], "topics": ["a"], "reasoning": "r"}' if len(text) % 6 < 4 else "prose"

    return answer


@query("classify_typed", f"""
WITH s AS (SELECT doc_id, length({strip_sql('text')}) < 100 AS short, least(length(text), 1500) AS n FROM documents)
SELECT doc_id, CASE WHEN NOT short AND n % 6 BETWEEN 1 AND 3 THEN 'PSD' END AS doc_type, CASE WHEN short THEN 'Text too short for classification' WHEN n % 6 = 0 THEN 'TimeoutError: busy' WHEN n % 6 > 3 THEN 'not JSON' END AS error FROM s""")
def typed(spark, d):
    return M.classify_typed(table(spark, d, "documents"), type_model, calls=ONE_BY_ONE).select("doc_id", "doc_type", "error")


@query("label_golden", "SELECT doc_id, CASE WHEN least(length(text), 600) % 6 BETWEEN 1 AND 3 THEN 'PSD' END AS detected_type, CASE WHEN least(length(text), 600) % 6 = 0 THEN 'TimeoutError: busy' WHEN least(length(text), 600) % 6 > 3 THEN 'not JSON' END AS error FROM documents")
def golden(spark, d):
    return M.label(table(spark, d, "documents"), type_model, calls=ONE_BY_ONE).select("doc_id", "detected_type", "error")


def fixing_model():
    return lambda prompt: '{"fixed": true}' if len(prompt) % 2 else "sorry"


@query("json_repair_model", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'repaired' WHEN 1 THEN CASE WHEN (length('Return this as valid JSON and nothing else:') + 1 + length('no ' || event_id)) % 2 = 1 THEN 'model' ELSE 'failed' END ELSE 'strict' END AS stage FROM events")
def model_repair(spark, d):
    raw = F.expr("CASE event_id % 4 WHEN 0 THEN concat(substring(props, 1, length(props) - 1), ',}') WHEN 1 THEN concat('no ', event_id) ELSE props END")
    return M.repair_with_model(table(spark, d, "events").select("event_id", raw.alias("raw")), "raw", fixing_model, calls=ONE_BY_ONE).select("event_id", "stage")


@query("page_type_text", "SELECT page_id, CASE WHEN page_id % 3 > 0 THEN 'This page is classified as `' || CASE WHEN page_id % 2 = 0 THEN 'table' ELSE 'unknown' END || '` and contains the following content: ' || url ELSE '' END AS text FROM pages")
def page_type(spark, d):
    return table(spark, d, "pages").select("page_id", M.page_type_text(F.expr("CASE WHEN page_id % 2 = 0 THEN 'table' END"), F.expr("CASE page_id % 6 WHEN 0 THEN NULL WHEN 3 THEN '' ELSE url END")).alias("text"))


@query("envelope", """
SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN source || '.pdf' ELSE 'Unknown' END AS source_document, CASE WHEN doc_id % 4 > 0 THEN doc_id::VARCHAR ELSE 'Unknown' END AS source_page_number, CASE WHEN doc_id % 2 = 0 THEN 'dense_text' ELSE 'Unknown' END AS kind,
  CASE doc_id % 3 WHEN 0 THEN '2020-12-25' WHEN 1 THEN '2019-02-28' END AS day, CASE doc_id % 3 WHEN 0 THEN 'content' WHEN 1 THEN 'path' ELSE 'none' END AS date_source, md5(CASE doc_id % 3 WHEN 0 THEN 'Date: 25/12/2020' ELSE 'none' END) AS h, true AS stamped FROM documents""")
def enveloped(spark, d):
    p = table(spark, d, "documents").select("doc_id", F.expr("CASE WHEN doc_id % 4 > 0 THEN concat(source, '_page_', doc_id, '.json') ELSE concat(doc_id, '.json') END").alias("file"), F.expr("CASE WHEN doc_id % 3 = 1 THEN '/in/2019-02-28/a.pdf' ELSE '/in/a.pdf' END").alias("source_file"), F.expr("CASE WHEN doc_id % 2 = 0 THEN 'dense_text' END").alias("classified_page_type"), F.expr("CASE WHEN doc_id % 3 = 0 THEN 'Date: 25/12/2020' ELSE 'none' END").alias("raw_text"), F.lit(None).cast("date").alias("modified"))
    e = M.envelope(p)
    m = lambda c: F.col(f"metadata.{c}")
    j = e.join(p.select("file", "doc_id"), "file")
    return j.select("doc_id", m("source_document"), m("source_page_number"), m("classified_page_type").alias("kind"), m("effective_date").alias("day"), m("date_source"), F.md5("content.data.raw_text").alias("h"), (m("processing_timestamp").isNotNull() & (m("extraction_tool_used") != "")).alias("stamped"))


@query("span_ids", "SELECT doc_id, line_no, nth, 'p1-b' || doc_id || '-s' || (nth - 1) AS span_id FROM (SELECT doc_id, line_no, unnest(w) AS w, generate_subscripts(w, 1) AS nth FROM (SELECT doc_id, (i - 1)::INT AS line_no, string_split(line, ' ') AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)))")
def spans(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    words = lines.select("doc_id", "line", F.posexplode(F.split("t", " ")).alias("ord", "w")).withColumn("element_id", F.concat(F.lit("p1-b"), F.col("doc_id").cast("string")))
    return M.span_ids(words).select("doc_id", F.col("line").alias("line_no"), (F.col("ord") + 1).cast("long").alias("nth"), "span_id")


@query("title_lookup", "SELECT doc_id, coalesce('L' || quality, 'Unknown Document') AS doc_title FROM documents LEFT JOIN labels USING (doc_id)")
def title_lookup(spark, d):
    t = table(spark, d, "labels").select("doc_id", F.concat(F.lit("L"), F.col("quality").cast("string")).alias("title"))
    return M.titles(table(spark, d, "documents").select("doc_id"), t)


@query("merge_sections", "SELECT conv_id AS doc_id, count(*) AS n, md5(string_agg(turn || ':' || role || ':' || text, '|' ORDER BY turn)) AS h FROM conversations WHERE role = 'user' GROUP BY conv_id")
def sections(spark, d):
    s = F.array(F.struct(F.when(F.col("role") == "user", F.col("role")).alias("heading"), F.col("text").alias("text")))
    m = M.merge_sections(table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), s.alias("sections")))
    lines = F.transform("sections", lambda x: F.concat_ws(":", x["page_start"].cast("string"), x["heading"], x["text"]))
    return m.select("doc_id", F.size("sections").cast("long").alias("n"), F.md5(F.array_join(lines, "|")).alias("h"))


@query("ocr_blank", "SELECT page_id, CASE WHEN contains(url, '?') THEN length(url) || ' characters' ELSE url END AS text FROM pages")
def ocr(spark, d):
    p = table(spark, d, "pages").select("page_id", F.expr("CASE WHEN contains(url, '?') THEN ' ' ELSE url END").alias("text"), F.col("url").alias("image"))
    return M.ocr_blank(p, length_model, calls=ONE_BY_ONE).select("page_id", "text")


@query("first_label", "SELECT doc_id, source AS label FROM documents")
def label(spark, d):
    raw = F.expr("CASE WHEN doc_id % 2 = 0 THEN to_json(array(source, lang)) ELSE concat('\"', source, '\"') END")
    return table(spark, d, "documents").select("doc_id", M.first_label(raw).alias("label"))


@query("mime_split", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'text/plain' END AS mime FROM documents")
def mime(spark, d):
    files = table(spark, d, "documents").select("doc_id", F.expr("CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.txt' ELSE '.xyz' END").alias("ext"))
    good, bad = M.mime_split(files)
    return good.select("doc_id", "mime").unionByName(bad.select("doc_id", F.lit(None).cast("string").alias("mime")))


@query("element_ids", "SELECT conv_id, turn, 'p' || (1 + turn // 4) || '-' || CASE role WHEN 'user' THEN 't' ELSE 'b' END || (row_number() OVER (PARTITION BY conv_id, turn // 4, role = 'user' ORDER BY turn) - 1) AS element_id FROM conversations")
def ids(spark, d):
    b = table(spark, d, "conversations").select("conv_id", "turn", F.col("conv_id").alias("doc_id"), F.expr("1 + turn div 4").alias("page"), F.col("turn").alias("ord"), F.expr("CASE role WHEN 'user' THEN 'table' ELSE 'text' END").alias("block_type"))
    return M.element_ids(b).select("conv_id", "turn", "element_id")


def counting_model():
    return lambda prompt: f"{len(prompt)} characters"


@query("cached_answers", """
WITH p AS (SELECT source, lang, 'Describe ' || lang || ' of ' || source AS prompt FROM documents WHERE doc_id % 10 > 0 UNION ALL SELECT source, lang, NULL FROM documents WHERE doc_id % 10 = 0)
SELECT source, lang, count(*) AS n, count(prompt) AS answered, coalesce(max(length(prompt) || ' characters'), '') AS answer, (SELECT count(DISTINCT prompt) FROM p) AS calls_first, 0::BIGINT AS calls_second FROM p GROUP BY source, lang""")
def cached(spark, d):
    """A prompt for most documents, few different ones; the second run over all of them asks nothing."""
    from .flow_queries import scratch

    cache = f"{scratch(spark)}/answers"
    asked = table(spark, d, "documents").select("source", "lang", F.expr("CASE WHEN doc_id % 10 > 0 THEN concat('Describe ', lang, ' of ', source) END").alias("prompt"))
    first, second = (cached_call(asked, "prompt", counting_model, cache, "counting", calls=Calls(concurrency=4)) for _ in range(2))
    runs = answers(spark, cache).groupBy("run").agg(F.count("*").alias("n")).agg(F.max("n").alias("calls_first"), (F.sum("n") - F.max("n")).alias("calls_second"))
    n = lambda df: df.groupBy("source", "lang").agg(F.count("*").alias("n"), F.count("answer").alias("answered"), F.coalesce(F.max("answer"), F.lit("")).alias("answer"))
    same = n(first).join(n(second), ["source", "lang", "n", "answered", "answer"])
    return same.join(F.broadcast(runs))  # one row

"""The jobs as queries: each runs twice into a new folder of the shared one and returns its whole output as it then stands; SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import ingest_chunks, publish_records
from lamina.plans.flow_queries import scratch
from lamina.plans.text_queries import packing_sql, sentences_sql, strip_sql


def job1_ingest_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as chunks; the second run finds nothing new."""
    root = scratch(spark)
    for _ in range(2):
        ingest_chunks.run(spark, f"{sf_dir}/{{documents.parquet}}", f"{root}/chunks", f"{root}/checkpoint")
    return ingest_chunks.current(spark, f"{root}/chunks")


def job2_publish_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as records; the second run replaces the first's files by equal ones."""
    root = scratch(spark)
    for _ in range(2):
        publish_records.run(spark, f"{sf_dir}/documents.parquet", f"{root}/out")
    out = publish_records.written_records(spark, f"{root}/out")
    meta = F.col("document_level_metadata")
    texts = F.md5(F.array_join(F.transform("chunks", lambda c: F.concat_ws("|", c["chunk_id"], c["text"])), "\n"))
    return out.select("doc_id", "lang", "status", "name", "title", "part", "n_parts", "n_chunks", meta["doc_id"].alias("meta_id"), meta["publication_date"].alias("published"), meta["date_source"].alias("date_source"), F.size("chunks").alias("n_here"), texts.alias("h"))


_CLEAN = strip_sql(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n|\r', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n\s*--- Page \d+ ---\s*\n', chr(10), 'g'), '(Confidential|PBAC Public Summary Document|Page \d+ of \d+)', '', 'gi')")
_PACKED = f"""n AS (SELECT doc_id, lang, source, text, {_CLEAN} AS clean FROM documents),
s AS (SELECT doc_id, {sentences_sql('clean')} AS sents, 1024 AS size, 200 AS overlap FROM n),
{packing_sql('s', 'doc_id', 'c')}"""
_JOB1 = f"""WITH RECURSIVE {_PACKED}
SELECT c.doc_id, n.lang, c.nth::INTEGER AS nth, sha256(concat_ws('|', c.doc_id, c.nth, c.chunk)) AS chunk_id, c.chunk AS text, length(c.chunk)::INTEGER AS n_chars,
       (length({strip_sql('c.chunk')}) < 20 OR len(regexp_extract_all({strip_sql('c.chunk')}, '[\\p{{L}}\\p{{N}}]')) / greatest(length({strip_sql('c.chunk')}), 1) < 0.5) AS low_value
FROM c JOIN n USING (doc_id)"""
_JOB2 = rf"""WITH RECURSIVE {_PACKED},
a AS (SELECT doc_id, (nth // 200)::INTEGER AS part, count(*)::INTEGER AS n_chunks, md5(string_agg(concat_ws('|', sha256(concat_ws('|', doc_id, nth, chunk)), chunk), chr(10) ORDER BY nth)) AS h FROM c GROUP BY ALL),
t AS (SELECT doc_id, sum(length(regexp_replace(chunk, '\s+', '', 'g'))) AS held, count(*)::INTEGER AS total FROM c GROUP BY doc_id),
m AS (SELECT n.doc_id, lang, concat_ws('-', source, n.doc_id) AS name, length(regexp_replace(clean, '\s+', '', 'g')) AS chars, held, coalesce(total, 0) AS total,
             coalesce(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {strip_sql('x')}), lambda x: length(x) > 0 AND len(regexp_extract_all(x, '\S+')) <= 15)[1], 'Untitled Document') AS title
      FROM n LEFT JOIN t ON t.doc_id = n.doc_id),
d AS (SELECT *, coalesce(try_strptime(regexp_extract(name, '([0-9]{{1,2}}-[0-9]{{4}})', 1), '%m-%Y'), try_strptime(regexp_extract(name, '\b(20[0-9]{{2}})\b', 1), '%Y'), TIMESTAMP '1970-01-01')::DATE AS day,
             CASE WHEN chars = 0 THEN 'no text' WHEN held / chars < 0.95 THEN 'incomplete' ELSE 'published' END AS status FROM m)
SELECT d.doc_id, lang, status, name, title, coalesce(part, 0) AS part, greatest(ceil(total / 200), 1)::INTEGER AS n_parts, total::INTEGER AS n_chunks, name AS meta_id, strftime(day, '%Y-%m-%dT00:00:00') AS published,
       CASE WHEN year(day) = 1970 THEN 'default_fallback' ELSE 'derived_from_filename' END AS date_source, coalesce(a.n_chunks, 0) AS n_here, coalesce(h, md5('')) AS h
FROM d LEFT JOIN a ON a.doc_id = d.doc_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (job1_ingest_chunks, job2_publish_records)}


def oracle_sql() -> dict[str, str]:
    return {"job1_ingest_chunks": _JOB1, "job2_publish_records": _JOB2}

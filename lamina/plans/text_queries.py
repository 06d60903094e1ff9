"""Queries of the text functions and of the predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.config import Config
from ..operators import boundaries as B
from ..operators import predicates as P
from .registry import query, table

#: DuckDB's strip of Unicode white space.
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def strip_sql(x: str) -> str:
    return _STRIP.format(x)


def marked(df):
    """Documents with the marks that cleaning looks for around their text."""
    n = F.col("doc_id").cast("string")
    return df.select("doc_id", F.concat(F.lit("  CONFIDENTIAL\r\n\r\n\r\n\r\n"), "text", F.lit("\t \tx\n --- Page "), n, F.lit(" --- \nend Page 1 of "), n, F.lit(" PBAC public summary document\r")).alias("raw"))


_RAW = r"""concat('  CONFIDENTIAL', chr(13), chr(10), chr(13), chr(10), chr(13), chr(10), chr(13), chr(10), text, chr(9), ' ', chr(9), 'x', chr(10), ' --- Page ', doc_id, ' --- ', chr(10), 'end Page 1 of ', doc_id, ' PBAC public summary document', chr(13))"""
_NORM = strip_sql(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(" + _RAW + r", '\r\n|\r', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n\s*--- Page \d+ ---\s*\n', chr(10), 'g'), '(Confidential|PBAC Public Summary Document|Page \d+ of \d+)', '', 'gi')")


@query("normalize_text", f"SELECT doc_id, length(t) AS n, md5(t) AS h FROM (SELECT doc_id, {_NORM} AS t FROM documents)")
def normalize(spark, d):
    t = T.normalize_text(F.col("raw"))
    return marked(table(spark, d, "documents")).select("doc_id", t.alias("t")).select("doc_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("h"))


@query("title_guess", rf"""
SELECT doc_id, coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip_sql('x')}), lambda x: length(x) > 0 AND len(regexp_extract_all(x, '\S+')) <= 15)[1], 'Untitled Document') AS title FROM documents""")
def title(spark, d):
    return table(spark, d, "documents").select("doc_id", T.title_guess(F.col("text")).alias("title"))


@query("markdown_headings", rf"""
WITH l AS (SELECT doc_id, list_transform(string_split('  LINE ' || doc_id || ' É' || chr(10) || text || chr(10) || '  42  ', chr(10)), lambda x: {strip_sql('x')}) AS lines FROM documents)
SELECT doc_id, md5(array_to_string(list_transform(lines, lambda s: CASE WHEN regexp_matches(s, '\p{{Lu}}') AND NOT regexp_matches(s, '[\p{{Ll}}\p{{Lt}}]') THEN '## ' || s ELSE s END), chr(10))) AS h FROM l""")
def headings(spark, d):
    t = F.concat(F.lit("  LINE "), F.col("doc_id").cast("string"), F.lit(" É\n"), "text", F.lit("\n  42  "))
    return table(spark, d, "documents").select("doc_id", F.md5(T.markdown_headings(t)).alias("h"))


@query("char_ratios", r"""
SELECT doc_id, round(len(regexp_extract_all(text, '[\p{L}\p{N}]')) / greatest(length(text), 1), 6) AS alnum, round(len(regexp_extract_all(text, '\p{Lu}')) / greatest(length(text), 1), 6) AS upper_share,
       len(regexp_extract_all(text, '\|'))::BIGINT AS pipes FROM documents""")
def ratios(spark, d):
    n = F.greatest(F.length("text"), F.lit(1))
    return table(spark, d, "documents").select("doc_id", F.round(T.alnum_count(F.col("text")) / n, 6).alias("alnum"), F.round(T.count_of(F.col("text"), r"\p{Lu}") / n, 6).alias("upper_share"), T.count_of(F.col("text"), r"\|").cast("long").alias("pipes"))


@query("chunk_type_snake", r"""
WITH p(nth, purpose) AS (VALUES (0, 'Background/Context'), (1, 'ClinicalTrial Design'), (2, 'Sponsor''s Justification'), (3, 'PBAC Recommendation'), (4, 'a__b C'))
SELECT doc_id, replace(replace(replace(lower(regexp_replace(regexp_replace(purpose || ' ' || source, '(.)([A-Z][a-z]+)', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g')), '/', '_'), ' ', '_'), '__', '_') AS chunk_type
FROM documents JOIN p ON nth = doc_id % 5""")
def snake(spark, d):
    names = F.array(*map(F.lit, ["Background/Context", "ClinicalTrial Design", "Sponsor's Justification", "PBAC Recommendation", "a__b C"]))
    return table(spark, d, "documents").select("doc_id", T.chunk_type_snake(F.concat_ws(" ", F.get(names, (F.col("doc_id") % 5).cast("int")), "source")).alias("chunk_type"))


@query("doc_hash", "SELECT doc_id, sha256(concat('src/', source, '_', doc_id, '.pdf')) AS name_hash, sha256(text) AS content_hash FROM documents")
def doc_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.concat(F.lit("src/"), "source", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".pdf")), 256).alias("name_hash"), F.sha2("text", 256).alias("content_hash"))


@query("word_windows", r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, words, unnest(range(0, len(words), 96)) AS i FROM w)
SELECT doc_id, (i // 96)::INT AS nth, md5(array_to_string(words[i + 1 : i + 128], ' ')) AS h FROM s""")
def windows(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.word_windows(F.col("text"), 128, 32)).alias("nth", "w")).select("doc_id", "nth", F.md5("w").alias("h"))


_SENT = r"""list_filter(list_transform(string_split(replace(regexp_replace(regexp_replace({0}, '(^|[\s(])(Dr|Mr|Mrs|Ms|Prof|St|vs|etc|Fig|No)\.(\s)', '\1\2' || chr(2) || '\3', 'g'), '([.!?][")\]'']*)\s+([^\s\p{{Ll}}])', '\1' || chr(1) || '\2', 'g'), chr(2), '.'), chr(1)), lambda x: {1}), lambda s: s <> '')"""


@query("sentences", f"SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(s, '|')) AS h FROM (SELECT doc_id, {_SENT.format(chr(39) + 'Dr. A met Mr. B. ' + chr(39) + ' || text', strip_sql('x'))} AS s FROM documents)")
def sents(spark, d):
    return table(spark, d, "documents").select("doc_id", T.sentences(F.concat(F.lit("Dr. A met Mr. B. "), "text")).alias("s")).select("doc_id", F.size("s").cast("long").alias("n"), F.md5(F.array_join("s", "|")).alias("h"))


def packing_sql(source: str, keys: str, result: str) -> str:
    """SQL for sentences packed greedily. source: a table of (keys, sents, size, overlap); result: the CTE (keys, nth, chunk). For WITH RECURSIVE."""
    k = ", ".join(f"q.{x.strip()}" for x in keys.split(","))
    return f"""fold_{result} AS (
  SELECT {k}, 0 AS i, []::VARCHAR[] AS cur, 0::BIGINT AS width, NULL::VARCHAR AS done FROM {source} q
  UNION ALL
  SELECT {keys}, i + 1, list_append(CASE WHEN is_full THEN rest ELSE cur END, x), CASE WHEN is_full THEN coalesce(list_sum(list_transform(rest, lambda y: length(y) + 1)), 0)::BIGINT ELSE width + CASE WHEN len(cur) > 0 THEN 1 ELSE 0 END END + length(x), CASE WHEN is_full THEN array_to_string(cur, ' ') END
  FROM (SELECT *, cur[list_filter(range(1, len(cur) + 2), lambda n: coalesce(list_sum(list_transform(cur[n:], lambda y: length(y) + 1)), 0) < overlap)[1]:] AS rest FROM (
    SELECT {k}, f.i, f.cur, f.width, q.sents[f.i + 1] AS x, q.overlap, len(f.cur) > 0 AND f.width + length(q.sents[f.i + 1]) + 1 > q.size AS is_full FROM fold_{result} f JOIN {source} q USING ({keys}) WHERE f.i < len(q.sents)))),
{result} AS (SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY i) - 1 AS nth, chunk FROM (
  SELECT {keys}, i, done AS chunk FROM fold_{result} WHERE done IS NOT NULL
  UNION ALL SELECT {k}, f.i + 1, array_to_string(f.cur, ' ') FROM fold_{result} f JOIN {source} q USING ({keys}) WHERE f.i = len(q.sents) AND len(f.cur) > 0))"""


def sentences_sql(x: str) -> str:
    return _SENT.format(x, strip_sql("x"))


@query("sentence_chunks", f"""
WITH RECURSIVE s AS (SELECT doc_id, {sentences_sql('text')} AS sents, 1024 AS size, 200 AS overlap FROM documents),
{packing_sql('s', 'doc_id', 'c')}
SELECT doc_id, nth::INT AS nth, length(chunk)::INT AS n, md5(chunk) AS h FROM c""")
def packed(spark, d):
    c = T.sentence_chunks(T.sentences(F.col("text")), 1024, 200)
    return table(spark, d, "documents").select("doc_id", F.posexplode(c).alias("nth", "chunk")).select("doc_id", "nth", F.length("chunk").alias("n"), F.md5("chunk").alias("h"))


_LOW = "(length(t) < 20 OR len(regexp_extract_all(t, '[\\p{L}\\p{N}]')) / greatest(length(t), 1) < 0.5)"


@query("low_value_chunks", f"SELECT doc_id, {_LOW} AS low FROM (SELECT doc_id, {strip_sql('text')} AS t FROM documents)")
def low(spark, d):
    return table(spark, d, "documents").select("doc_id", P.low_value(F.col("text")).alias("low"))


_LINES = "SELECT doc_id, (i - 1)::INT AS line_no, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"


def lines(spark, d):
    return table(spark, d, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query("header_predicate", rf"""
WITH l AS ({_LINES}), v AS (SELECT doc_id, line_no, {strip_sql("CASE line_no % 6 WHEN 0 THEN '- ' || line WHEN 1 THEN line_no::VARCHAR WHEN 2 THEN 'xiv' WHEN 3 THEN 'a|b|c|' || line WHEN 4 THEN '3.' ELSE line END")} AS t FROM l)
SELECT doc_id, line_no, (length(t) > 0 AND length(t) <= 300 AND NOT regexp_matches(t, '^[•\x{{f0b7}}\-*][\s\p{{Z}}]') AND NOT regexp_matches(t, '^o [\s\p{{Z}}]') AND NOT starts_with(t, 'o ')
  AND len(regexp_extract_all(t, '\|')) < 3 AND NOT regexp_full_match(t, '\p{{Nd}}+') AND NOT (length(t) <= 3 AND NOT regexp_matches(t, '[a-zA-Z]')) AND NOT regexp_full_match(lower(t), '[ivx]+') AND regexp_matches(t, '[a-zA-Z]')) AS header FROM v""")
def header(spark, d):
    t = F.expr("CASE line_no % 6 WHEN 0 THEN concat('- ', line) WHEN 1 THEN cast(line_no AS string) WHEN 2 THEN 'xiv' WHEN 3 THEN concat('a|b|c|', line) WHEN 4 THEN '3.' ELSE line END")
    return lines(spark, d).select("doc_id", "line_no", P.is_header(t).alias("header"))


_REASON = rf"""
WITH l AS ({_LINES}),
v AS (SELECT doc_id, line_no, 1 + line_no // 4 AS page, CASE WHEN line_no % 4 = 0 THEN 40.0 ELSE 150.0 + 180.0 * (line_no % 4) END AS y0,
      {strip_sql("CASE line_no % 9 WHEN 1 THEN '12 of 40' WHEN 2 THEN 'xi' WHEN 3 THEN '--' WHEN 4 THEN 'Table 3.1 ' || line WHEN 5 THEN 'Acme Pty Ltd ' || line WHEN 6 THEN '' WHEN 7 THEN 'Figure 2.1' || line ELSE line END")} AS t FROM l),
r AS (SELECT t FROM v GROUP BY t HAVING count(*) > 20)
SELECT doc_id, line_no, CASE
  WHEN t = '' THEN 'blank'
  WHEN t IN (SELECT t FROM r) THEN 'repeated'
  WHEN length(t) < 15 AND (regexp_full_match(t, '\p{{Nd}}+') OR regexp_full_match(t, '(?i)\p{{Nd}}+\s+of\s+\p{{Nd}}+') OR regexp_full_match(t, '[ivxIVX]+')) THEN 'page_number'
  WHEN length(t) <= 3 AND NOT regexp_matches(t, '[\p{{L}}\p{{N}}]') THEN 'noise'
  WHEN (842.0 - (y0 + 20.0) < 100 OR y0 < 100) AND length(t) > 30 AND regexp_matches(t, '(?i)Guidelines for preparing a submission to the PBAC, Version \d+\.\d+, September \d+|^Flowchart \d+\.\d+\s+Overview of|^Figure \d+\.\d+') THEN 'margin'
  WHEN length(t) < 300 AND regexp_matches(t, '(?i)^(Table|Figure|Flowchart) \d+\.?\d*(\.?\d*)?\s+') THEN 'caption'
  WHEN page <= 5 AND y0 < 842.0 * 0.3 AND length(t) > 10 AND length(t) < 150 AND (regexp_matches(t, '(?i)(PTY LTD|LIMITED|INC|CORP|PHARMACEUTICAL|DRUG|MEDICINE|PRODUCT)\b') OR (length(t) > 15 AND len(regexp_extract_all(t, '\p{{Lu}}')) / length(t) > 0.7) OR regexp_matches(t, '^\s*\(?[\p{{L}}\p{{N}}_]+\s+([A-Z\s]+)\)?$')) THEN 'title'
END AS reason FROM v"""


@query("noncontent_reason", _REASON)
def reason(spark, d):
    t = F.expr("CASE line_no % 9 WHEN 1 THEN '12 of 40' WHEN 2 THEN 'xi' WHEN 3 THEN '--' WHEN 4 THEN concat('Table 3.1 ', line) WHEN 5 THEN concat('Acme Pty Ltd ', line) WHEN 6 THEN '' WHEN 7 THEN concat('Figure 2.1', line) ELSE line END")
    y0 = F.when(F.col("line_no") % 4 == 0, 40.0).otherwise(150.0 + 180.0 * (F.col("line_no") % 4))
    v = lines(spark, d).select("doc_id", "line_no", F.expr("1 + line_no div 4").alias("page"), y0.alias("y0"), T.strip(t).alias("t"))
    repeated = v.groupBy("t").count().filter("count > 20").select("t", F.lit(True).alias("again"))
    v = v.join(repeated, "t", "left")
    return v.select("doc_id", "line_no", P.noncontent_reason(F.col("t"), F.col("page"), F.col("y0"), F.col("y0") + 20.0, F.lit(842.0), F.coalesce("again", F.lit(False))).alias("reason"))


@query("data_table_predicate", rf"""
WITH m AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '|a|b|c|' || chr(10) || '|---|---|---|' || chr(10) || '|11|22|33|' || chr(10) || '|44|55|66|' WHEN 1 THEN '|Contents|x|y|' || chr(10) || text WHEN 2 THEN '|a|b|c|' || chr(10) || '|d|e|f|' || chr(10) || text ELSE text END AS md FROM documents),
l AS (SELECT doc_id, md, list_filter(string_split({strip_sql('md')}, chr(10)), lambda x: NOT starts_with(x, '|---') AND length({strip_sql('x')}) > 5) AS dl FROM m),
c AS (SELECT doc_id, md, len(dl) AS n, len(list_filter(dl, lambda x: length(x) - length(replace(x, '|', '')) >= 3)) AS s, len(regexp_extract_all(md, '[\p{{L}}\p{{N}}]')) AS a, length(md) - length(replace(md, '|', '')) AS pipes FROM l)
SELECT doc_id, (md <> '' AND NOT regexp_matches(lower(md), 'foreword|contents|table of contents|record of updates|abbreviations and acronyms') AND NOT (n > 0 AND (s / n < 0.2 OR (n < 3 AND s < 2))) AND NOT (pipes > 0 AND a / pipes > 50)) AS data_table FROM c""")
def data_table(spark, d):
    md = F.expr("CASE doc_id % 4 WHEN 0 THEN '|a|b|c|\n|---|---|---|\n|11|22|33|\n|44|55|66|' WHEN 1 THEN concat('|Contents|x|y|\n', text) WHEN 2 THEN concat('|a|b|c|\n|d|e|f|\n', text) ELSE text END")
    return table(spark, d, "documents").select("doc_id", P.is_data_table(md).alias("data_table"))


@query("clean_path", "SELECT doc_id, source || ' > ' || lang AS path FROM documents")
def path(spark, d):
    p = F.array("source", "source", "lang", "lang", "lang")
    return table(spark, d, "documents").select("doc_id", F.array_join(T.clean_path(p), " > ").alias("path"))


@query("adaptive_config", r"""
WITH t(nth, title) AS (VALUES (0, 'Metadata of Trial'), (1, 'Introduction'), (2, 'Safety and Conclusion'), (3, 'Other'), (4, 'APPENDIX A'))
SELECT doc_id, CASE WHEN nth IN (0, 2) THEN 512 WHEN nth IN (1, 4) THEN 1536 ELSE 1024 END AS size, CASE WHEN nth IN (0, 2) THEN 100 WHEN nth IN (1, 4) THEN 250 ELSE 200 END AS overlap FROM documents JOIN t ON nth = doc_id % 5""")
def adaptive(spark, d):
    c = Config()
    titles = F.array(*map(F.lit, ["Metadata of Trial", "Introduction", "Safety and Conclusion", "Other", "APPENDIX A"]))
    size, over = T.adaptive_size(F.array("source", F.get(titles, (F.col("doc_id") % 5).cast("int"))), c.rules, c.default_chunk)
    return table(spark, d, "documents").select("doc_id", size.alias("size"), over.alias("overlap"))


def abbreviated(df):
    """Documents with abbreviations before some of their words, and an initial in front."""
    n = F.col("doc_id") % 3
    t = F.when(n == 0, F.regexp_replace("text", r" (the|die|les|los) ", " approx. $1 ")).when(n == 1, F.regexp_replace("text", r" (of|in|de|en) ", " e.g. $1 ")).otherwise(F.col("text"))
    return df.select("doc_id", F.concat(F.lit("J. Smith "), t).alias("text"))


_ABBREVIATED = r"""x AS (SELECT doc_id, 'J. Smith ' || CASE doc_id % 3 WHEN 0 THEN regexp_replace(text, ' (the|die|les|los) ', ' approx. \1 ', 'g') WHEN 1 THEN regexp_replace(text, ' (of|in|de|en) ', ' e.g. \1 ', 'g') ELSE text END AS text FROM documents)"""
_BARE = "regexp_replace(x, '^[\"''(\\[{«“‘]+|[\"'')\\]}»”’]+$', '', 'g')"
_TOKENS = rf"""{_ABBREVIATED},
w AS (SELECT list_transform(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''), lambda x: {_BARE}) AS w FROM x),
o AS (SELECT unnest(w) AS w, unnest(list_prepend(NULL, w[:-2])) AS p FROM w),
t AS (SELECT lower(regexp_replace(w, '\.+$', '')) AS type, ends_with(w, '.') AND NOT ends_with(w, '..') AS dot, lower(regexp_replace(p, '\.+$', '')) AS prev, coalesce(ends_with(p, '.') AND NOT ends_with(p, '..'), false) AS prev_dot, coalesce(regexp_matches(p, '[!?]$'), false) AS prev_end FROM o),
s AS (SELECT type, count(*) FILTER (dot) AS c, count(*) AS n FROM t GROUP BY type),
g AS (SELECT sum(n)::DOUBLE AS total, sum(c)::DOUBLE AS dots FROM s),
a AS (SELECT type, -2 * (c * ln(dots / total) + CASE WHEN n = c THEN 0 ELSE (n - c) * ln(1 - dots / total) END - c * ln(0.99) - (n - c) * ln(0.01)) * exp(-(length(replace(type, '.', '')))) * (length(type) - length(replace(type, '.', '')) + 1) * pow(length(replace(type, '.', ''))::DOUBLE, -(n - c)::DOUBLE) AS score
      FROM s, g WHERE c > 0 AND regexp_matches(type, '^\p{{L}}[\p{{L}}.\-]*$')),
short AS (SELECT * FROM a WHERE score >= 0.3)"""


@query("abbreviations_trained", f"WITH {_TOKENS} SELECT type, round(score, 4) AS score FROM short")
def abbreviations(spark, d):
    return B.abbreviations(B.counts(B.tokens(abbreviated(table(spark, d, "documents"))))).select("type", F.round("score", 4).alias("score"))


@query("starters_trained", rf"""WITH {_TOKENS},
b AS (SELECT type, count(*)::DOUBLE AS k FROM t WHERE prev_end OR (prev_dot AND NOT regexp_matches(prev, '^(\p{{Nd}}+|\p{{L}})$') AND prev NOT IN (SELECT type FROM short)) GROUP BY type),
z AS (SELECT b.type, k, s.n::DOUBLE AS n, total, (SELECT sum(k) FROM b) AS breaks FROM b JOIN s ON s.type = b.type, g WHERE regexp_matches(b.type, '^\p{{L}}+$')),
l AS (SELECT *, n / total AS p, k / breaks AS p1, (n - k) / (total - breaks) AS p2 FROM z WHERE total / breaks > n / k),
r AS (SELECT type, -2 * (k * ln(p) + (breaks - k) * ln(1 - p) + (n - k) * ln(p) + (total - breaks - n + k) * ln(1 - p) - CASE WHEN breaks = k THEN 0 ELSE k * ln(p1) + (breaks - k) * ln(1 - p1) END
      - CASE WHEN p2 <= 0 OR p2 >= 1 THEN 0 ELSE (n - k) * ln(p2) + (total - breaks - n + k) * ln(1 - p2) END) AS score FROM l)
SELECT type, round(score, 4) AS score FROM r WHERE score >= 30""")
def sentence_starters(spark, d):
    from .flow_queries import scratch

    # written once: what follows would count all tokens anew for each of its uses
    path = f"{scratch(spark)}/tokens"
    B.tokens(abbreviated(table(spark, d, "documents"))).write.parquet(path)
    toks = spark.read.parquet(path)
    stats = B.counts(toks)
    return B.starters(stats, B.pairs(toks), B.abbreviations(stats)).select("type", F.round("score", 4).alias("score"))


@query("sentences_trained")
def trained(spark, d):
    """All documents cut by what they teach themselves."""
    docs = abbreviated(table(spark, d, "documents"))
    return B.sentences_trained(docs, B.learn(docs)).select("doc_id", F.size("sentences").alias("n"), F.md5(F.array_join("sentences", "|")).alias("h"))

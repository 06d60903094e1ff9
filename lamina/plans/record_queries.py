"""Queries of dates, JSON, validation, enrichment, incremental runs, graph and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import jsonx as J
from ..functions import text as T
from ..operators import enrich as E
from ..operators import evaluate as V
from ..operators import graph as G
from ..operators import incremental as I
from ..operators import quality as Q
from ..operators.calls import ONE_BY_ONE
from .registry import query, table
from .text_queries import strip_sql

_DAY = "TIMESTAMP '2021-01-01' + to_days((o_orderkey % 700)::INT)"


def orders(spark, d):
    return table(spark, d, "orders").withColumn("day", F.expr("timestamp_ntz'2021-01-01' + make_dt_interval(cast(o_orderkey % 700 AS int))"))


@query("date_hierarchy", rf"""
WITH o AS (SELECT o_orderkey, {_DAY} AS day, CASE o_orderkey % 7 WHEN 0 THEN 'Published on: ' || strftime({_DAY}, '%m/%d/%Y') WHEN 1 THEN 'Effective Date: ' || strftime({_DAY}, '%Y-%m-%d') WHEN 2 THEN 'revision: ' || strftime({_DAY}, '%B %-d, %Y') WHEN 3 THEN 'Date: 25/12/2020' WHEN 4 THEN 'Date: 31/31/2020' ELSE 'none' END AS text,
  CASE WHEN o_orderkey % 3 = 0 THEN '/in/' || strftime({_DAY}, '%Y-%m-%d') || '/x' WHEN o_orderkey % 3 = 1 THEN '/in/2020-13-40' ELSE '/in' END AS dir, CASE WHEN o_orderkey % 5 = 0 THEN 'a_2019-02-28.pdf' ELSE 'a.pdf' END AS name, CASE WHEN o_orderkey % 2 = 0 THEN DATE '2018-05-06' END AS mtime FROM orders),
c AS (SELECT *, CASE o_orderkey % 7 WHEN 0 THEN day::DATE WHEN 1 THEN day::DATE WHEN 2 THEN day::DATE WHEN 3 THEN DATE '2020-12-25' END AS d1, CASE WHEN o_orderkey % 3 = 0 THEN day::DATE END AS d2, CASE WHEN o_orderkey % 5 = 0 THEN DATE '2019-02-28' END AS d3 FROM o)
SELECT o_orderkey, strftime(coalesce(d1, d2, d3, mtime), '%Y-%m-%d') AS effective, CASE WHEN d1 IS NOT NULL THEN 'content' WHEN d2 IS NOT NULL THEN 'path' WHEN d3 IS NOT NULL THEN 'filename' WHEN mtime IS NOT NULL THEN 'filesystem_modified' ELSE 'none' END AS source,
  CASE WHEN d1 IS NOT NULL THEN 1.0 WHEN d2 IS NOT NULL THEN 0.7 WHEN d3 IS NOT NULL THEN 0.8 WHEN mtime IS NOT NULL THEN 0.5 ELSE 0.0 END::DOUBLE AS confidence FROM c""")
def hierarchy(spark, d):
    o = orders(spark, d)
    text = F.expr("CASE o_orderkey % 7 WHEN 0 THEN concat('Published on: ', date_format(day, 'MM/dd/yyyy')) WHEN 1 THEN concat('Effective Date: ', date_format(day, 'yyyy-MM-dd')) WHEN 2 THEN concat('revision: ', date_format(day, 'MMMM d, yyyy')) WHEN 3 THEN 'Date: 25/12/2020' WHEN 4 THEN 'Date: 31/31/2020' ELSE 'none' END")
    path = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN concat('/in/', date_format(day, 'yyyy-MM-dd'), '/x') WHEN o_orderkey % 3 = 1 THEN '/in/2020-13-40' ELSE '/in' END")
    name = F.expr("CASE WHEN o_orderkey % 5 = 0 THEN 'a_2019-02-28.pdf' ELSE 'a.pdf' END")
    day, source, sure = D.date_hierarchy(text, path, name, F.expr("CASE WHEN o_orderkey % 2 = 0 THEN date'2018-05-06' END"))
    return o.select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("effective"), source.alias("source"), sure.alias("confidence"))


@query("docid_date", rf"""
WITH o AS (SELECT o_orderkey, {_DAY} AS day FROM orders)
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(day, '%Y-%m-01') WHEN 1 THEN strftime(day, '%Y-%m-01') WHEN 2 THEN strftime(day, '%Y-%m-01') WHEN 3 THEN strftime(day, '%Y-01-01') WHEN 4 THEN '2022-01-01' ELSE '1970-01-01' END AS effective,
  CASE WHEN o_orderkey % 6 = 5 THEN 'default_fallback' ELSE 'derived_from_filename' END AS source FROM o""")
def docid(spark, d):
    c = F.expr("CASE o_orderkey % 6 WHEN 0 THEN concat('psd-', date_format(day, 'M-yyyy')) WHEN 1 THEN concat('x-', lower(date_format(day, 'MMM-yyyy'))) WHEN 2 THEN concat('x-', date_format(day, 'MMMM-yyyy')) WHEN 3 THEN concat('guide ', date_format(day, 'yyyy'), ' v5') WHEN 4 THEN 'x-13-2022' ELSE 'none' END")
    day, source = D.docid_date(c)
    return orders(spark, d).select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("effective"), source.alias("source"))


@query("parse_page_name", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Unknown' ELSE source || '_page_' END AS document, CASE WHEN doc_id % 5 > 0 THEN doc_id::INT END AS page FROM documents")
def page_name(spark, d):
    doc, page = T.parse_page_name(F.expr("CASE WHEN doc_id % 5 = 0 THEN 'x.json' ELSE concat(source, '_page__page_', doc_id, '.json') END"))
    return table(spark, d, "documents").select("doc_id", doc.alias("document"), page.alias("page"))


@query("validate_docs", r"""
WITH v AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'T' END AS title, doc_id % 11 = 3 AS no_sections, doc_id % 5 = 1 AS no_heading, CASE doc_id % 4 WHEN 0 THEN '03/04/2021' WHEN 1 THEN 'March 4, 2021' WHEN 2 THEN 'soon' END AS day FROM documents)
SELECT doc_id, CASE WHEN title = '' OR no_sections THEN 'error' WHEN day = 'soon' OR no_heading THEN 'success_with_warnings' ELSE 'success' END AS status,
 CASE WHEN title = '' THEN 'Missing or empty required field: ''title''' WHEN no_sections THEN 'Missing or empty required field: ''sections''' ELSE '' END AS errors,
 CASE WHEN title = '' OR no_sections THEN '' ELSE concat_ws('|', CASE WHEN day = 'soon' THEN 'Could not parse date: ''soon''. Setting to null.' END, CASE WHEN no_heading THEN 'Section at index 1 is missing a ''heading''.' END) END AS warnings,
 CASE WHEN title = '' OR no_sections THEN day WHEN day = '03/04/2021' THEN '2021-03-04' WHEN day = 'March 4, 2021' THEN '2021-03-04' END AS day FROM v""")
def validate(spark, d):
    s = F.expr("CASE WHEN doc_id % 11 = 3 THEN cast(array() AS array<struct<heading:string,text:string>>) ELSE array(named_struct('heading', 'a', 'text', 'x'), named_struct('heading', CASE WHEN doc_id % 5 = 1 THEN '' ELSE 'b' END, 'text', 'y')) END")
    docs = table(spark, d, "documents").select("doc_id", F.expr("CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'T' END").alias("title"), s.alias("sections"), F.expr("CASE doc_id % 4 WHEN 0 THEN '03/04/2021' WHEN 1 THEN 'March 4, 2021' WHEN 2 THEN 'soon' END").alias("pbac_meeting_date"))
    v = Q.validate_docs(docs.withColumn("doc_id", F.col("doc_id").cast("string")))
    return v.select(F.col("doc_id").cast("long").alias("doc_id"), "status", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"), F.col("pbac_meeting_date").alias("day"))


_GOOD = '{"semantic_purpose":{"value":"Miscellaneous","confidence":0.5,"justification":"j"},"persona_relevance_scores":{"clinical_analyst":{"score":0.1,"justification":"j"},"health_economist":{"score":0.2,"justification":"j"},"regulatory_specialist":{"score":1.0,"justification":"j"}},"typed_entities":[{"name":"n","type":"DRUG"}],"quality_assessment":{"confidence":1.0,"is_ambiguous":false,"justification":"j"}}'


@query("payload_validate", """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'semantic_purpose.value' WHEN 2 THEN 'semantic_purpose' WHEN 3 THEN 'typed_entities' WHEN 4 THEN 'unknown key' WHEN 5 THEN 'not JSON' ELSE 'persona_relevance_scores' END AS errors FROM events""")
def payload(spark, d):
    g = F.lit(_GOOD)
    cases = [g, F.replace(g, F.lit("Miscellaneous"), F.lit("Other")), F.replace(g, F.lit('"confidence":0.5'), F.lit('"confidence":1.5')), F.replace(g, F.lit("DRUG"), F.lit("THING")), F.replace(g, F.lit('{"semantic'), F.lit('{"extra":1,"semantic')), F.substring(g, 1, 50), F.replace(g, F.lit('"score":0.2'), F.lit('"score":-1'))]
    raw = F.get(F.array(*cases), (F.col("event_id") % 7).cast("int"))
    return table(spark, d, "events").select("event_id", F.array_join(Q.payload_errors(raw), "|").alias("errors"))


_FENCED = "CASE event_id % 4 WHEN 0 THEN 'Sure:' || chr(10) || '```json' || chr(10) || props || chr(10) || '```' WHEN 1 THEN 'x ' || props || ' y' WHEN 2 THEN 'no json' ELSE '```[1, 2]```' END"


@query("json_fence_extract", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN props WHEN 2 THEN 'no json' ELSE '[1, 2]' END AS j FROM events")
def fence(spark, d):
    raw = F.expr("CASE event_id % 4 WHEN 0 THEN concat('Sure:\n```json\n', props, '\n```') WHEN 1 THEN concat('x ', props, ' y') WHEN 2 THEN 'no json' ELSE '```[1, 2]```' END")
    return table(spark, d, "events").select("event_id", J.fenced(raw).alias("j"))


@query("json_fallback", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'plain ' || event_id ELSE 's' || event_id END AS summary, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS tags, CASE WHEN event_id % 3 = 0 THEN 'manual_review_required' ELSE 'ok' END AS classification FROM events""")
def fallback(spark, d):
    raw = F.expr("CASE WHEN event_id % 3 = 0 THEN concat('  plain ', event_id, ' \n') ELSE concat('{\"summary\":\"s', event_id, '\",\"tags\":[\"t\"],\"classification\":\"ok\"}') END")
    return table(spark, d, "events").select("event_id", J.or_fallback(raw).alias("j")).select("event_id", "j.summary", F.size("j.tags").alias("tags"), "j.classification")


@query("json_repair_stage", "SELECT CASE event_id % 4 WHEN 0 THEN 'repaired' WHEN 1 THEN 'failed' ELSE 'strict' END AS stage, count(*) AS n FROM events GROUP BY 1")
def repair(spark, d):
    raw = F.expr("CASE event_id % 4 WHEN 0 THEN concat(substring(props, 1, length(props) - 1), ',}') WHEN 1 THEN 'no' ELSE props END")
    return J.repair_stage(table(spark, d, "events").select("event_id", raw.alias("raw")), "raw").groupBy("stage").agg(F.count("*").alias("n"))


#: Ways in which an answer about an event is broken; {i} and {t} are its id and type.
_SLIPS = ("{'id': {i}, 'type': '{t}',}", '{id: {i}, type: "{t}"', 'Here:\n```json\n{"id": {i} "type": "{t}"}\n```', '{"id": {i}, // the id\n "type": "{t}", "more": [1, 2}', '{"id" = +{i}, "type" => "{t}", "x', '[{"id": {i}, "type": "{t}"}', '{"id": {i}, "said": "so "it" is", "type": "{t}"}', 'no answer')


@query("json_mended", "SELECT event_id, CASE WHEN event_id % 8 = 7 THEN 'failed' ELSE 'repaired' END AS stage, CASE WHEN event_id % 8 < 7 THEN event_id END AS id, CASE WHEN event_id % 8 < 7 THEN event_type END AS type FROM events")
def mended(spark, d):
    """Answers about events, each broken in one of several ways, and read again."""
    slip = F.get(F.array(*map(F.lit, _SLIPS)), (F.col("event_id") % 8).cast("int"))
    raw = F.replace(F.replace(slip, F.lit("{i}"), F.col("event_id").cast("string")), F.lit("{t}"), F.col("event_type"))
    done = J.repair_stage(table(spark, d, "events").select("event_id", raw.alias("raw")), "raw")
    at = lambda k: F.coalesce(F.get_json_object("raw", f"$.{k}"), F.get_json_object("raw", f"$[0].{k}"))
    ok = F.col("stage") != "failed"
    return done.select("event_id", "stage", F.when(ok, at("id").cast("long")).alias("id"), F.when(ok, at("type")).alias("type"))


@query("balanced_object", "SELECT event_id, props AS j FROM events")
def balanced(spark, d):
    @F.pandas_udf("string")
    def first(s):
        return s.map(J.first_object)

    return table(spark, d, "events").select("event_id", first(F.concat(F.lit("answer {not json} then "), "props", F.lit(" and {\"b\":2}"))).alias("j"))


def chunks(spark, d):
    """Lines of texts as chunks."""
    c = table(spark, d, "documents").select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("nth", "text"))
    return c.select(F.concat_ws("-", F.col("doc_id").cast("string"), F.col("nth").cast("string")).alias("chunk_id"), "doc_id", "text", F.expr("CASE WHEN nth % 4 = 3 THEN 'table_summary' ELSE 'semantic_text' END").alias("chunk_type"), F.when(F.col("nth") % 6 == 5, F.array().cast("array<int>")).otherwise(F.array((F.col("nth") / 5 + 1).cast("int"))).alias("page_numbers"))


_C = "l AS (SELECT doc_id || '-' || (i - 1) AS chunk_id, doc_id, line AS text, i - 1 AS nth FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))"
#: The offline model's choices by the prompt's digest: it fails, answers with a purpose that isn't in the vocabulary, or with a payload.
_MODEL = f"""m AS (SELECT *, {strip_sql('text')} AS t, md5('DOCUMENT: ' || CASE WHEN doc_id % 5 = 0 THEN 'Unknown Document' ELSE source END || chr(10) || 'SECTION: ' || source || ' -> ' || lang || chr(10) || 'TEXT: ' || text) AS h FROM l JOIN (SELECT doc_id, source, lang FROM documents) USING (doc_id)),
b AS (SELECT *, list_transform(range(0, 5), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::INT) AS n FROM m),
e AS (SELECT *, (length(t) < 20 OR len(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]')) / greatest(length(t), 1) < 0.5) AS low, n[1] % 23 = 0 AS fails, n[1] % 23 > 0 AND n[3] % 11 = 0 AS wrong, [{', '.join(repr(p) if chr(39) not in p else chr(39) + p.replace(chr(39), chr(39) * 2) + chr(39) for p in Q.PURPOSES)}][n[2] % 12 + 1] AS purpose FROM b),
r AS (SELECT *, CASE WHEN low THEN NULL WHEN fails THEN 'ValueError: no answer' WHEN wrong THEN 'invalid payload: semantic_purpose.value' END AS error FROM e)"""
_SNAKE = r"replace(replace(replace(lower(regexp_replace(regexp_replace(purpose, '(.)([A-Z][a-z]+)', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g')), '/', '_'), ' ', '_'), '__', '_')"


def titled_chunks(spark, d):
    """Chunks with their document's title, where it is known, and section path."""
    docs = table(spark, d, "documents").select("doc_id", F.expr("CASE WHEN doc_id % 5 > 0 THEN source END").alias("doc_title"), F.array("source", "lang").alias("section_path"))
    return chunks(spark, d).join(docs, "doc_id")


@query("enrich_chunks", f"""WITH {_C}, {_MODEL} SELECT chunk_id, CASE WHEN low THEN 'Miscellaneous' WHEN error IS NULL THEN purpose END AS purpose, CASE WHEN low THEN 1.0 WHEN error IS NULL THEN n[4] % 5 / 4 END::DOUBLE AS confidence, CASE WHEN low THEN 0.0 WHEN error IS NULL THEN 0.5 END::DOUBLE AS economist,
 CASE WHEN low THEN 0 WHEN error IS NULL THEN 1 END::INT AS entities, CASE WHEN low THEN true WHEN error IS NULL THEN false END AS ambiguous, CASE WHEN low THEN 'miscellaneous' WHEN nth % 4 = 3 THEN 'table_summary' WHEN error IS NULL THEN {_SNAKE} ELSE 'semantic_text' END AS chunk_type, error FROM r""")
def enriched(spark, d):
    e = E.enrich(titled_chunks(spark, d), calls=ONE_BY_ONE)
    return e.select("chunk_id", F.col("semantic_purpose.value").alias("purpose"), F.col("semantic_purpose.confidence").alias("confidence"), F.try_element_at("persona_relevance_scores", F.lit("health_economist"))["score"].alias("economist"), F.when(F.col("typed_entities").isNotNull(), F.size("typed_entities")).alias("entities"), F.col("quality_assessment.is_ambiguous").alias("ambiguous"), "chunk_type", "error")


@query("quarantine_split", f"WITH {_C}, {_MODEL} SELECT chunk_id, error AS error_message, CASE WHEN nth % 4 = 3 THEN 'table_summary' ELSE 'semantic_text' END AS chunk_type, md5(text) AS h FROM r WHERE error IS NOT NULL")
def quarantine(spark, d):
    from .flow_queries import scratch

    q = E.quarantine_split(E.enrich(titled_chunks(spark, d), calls=ONE_BY_ONE), scratch(spark))[1]
    return q.select("chunk_id", "error_message", F.get_json_object("original_chunk", "$.chunk_type").alias("chunk_type"), F.md5(F.get_json_object("original_chunk", "$.text")).alias("h"))


@query("save_enriched", f"WITH {_C}, {_MODEL} SELECT CASE WHEN error IS NULL THEN 'enriched' ELSE 'failed' END AS part, doc_id, count(*) AS n FROM r GROUP BY ALL")
def save_enriched(spark, d):
    from ..sources import sinks
    from .flow_queries import scratch

    root = scratch(spark)
    sinks.save_enriched(E.enrich(titled_chunks(spark, d), calls=ONE_BY_ONE), root)
    count = lambda part: spark.read.schema("chunk_id string, doc_id long").json(f"{root}/{part}").groupBy("doc_id").agg(F.count("*").alias("n")).withColumn("part", F.lit(part))
    return count("enriched").unionByName(count("failed"))


@query("ordered_chunks", f"WITH {_C} SELECT chunk_id, row_number() OVER (ORDER BY CASE WHEN nth % 6 = 5 THEN NULL ELSE nth // 5 + 1 END NULLS LAST, chunk_id) AS rank FROM l")
def ordered(spark, d):
    from pyspark.sql import Window

    # ranks in the sorted order: the partitions of a range sort are in order, so ranks are counts before a partition and within it
    c = E.ordered_chunks(chunks(spark, d)).select("chunk_id", F.get("page_numbers", F.lit(0)).alias("page"), F.spark_partition_id().alias("part"))
    before = c.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("page").asc_nulls_last(), "chunk_id"))
    return c.withColumn("own", own).join(F.broadcast(before), "part").select("chunk_id", (F.col("before") + F.col("own")).cast("long").alias("rank"))  # a row for each partition


@query("prompt_render", "SELECT doc_id, md5('DOCUMENT: ' || source || chr(10) || 'SECTION: ' || lang || chr(10) || 'TEXT: ' || text) AS h FROM documents")
def prompts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(E.render("chunk_enrichment", title=F.col("source"), section=F.col("lang"), text=F.col("text"))).alias("h"))


@query("first_nonnull_merge", """
WITH p AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN text END AS title, CASE WHEN turn > 1 THEN role ELSE '' END AS drug_name FROM conversations)
SELECT conv_id AS doc_id, arg_min(title, turn) FILTER (title IS NOT NULL AND title <> '') AS title, arg_min(drug_name, turn) FILTER (drug_name <> '') AS drug_name FROM p GROUP BY conv_id""")
def merged(spark, d):
    p = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.expr("CASE WHEN turn % 2 = 1 THEN text END").alias("title"), F.expr("CASE WHEN turn > 1 THEN role ELSE '' END").alias("drug_name"))
    return E.first_nonnull_merge(p, ["title", "drug_name"])


@query("status_counts", f"WITH {_C}, {_MODEL} SELECT CASE WHEN error IS NOT NULL THEN 'failed' ELSE 'success' END AS status, count(*) AS n FROM r GROUP BY 1")
def statuses(spark, d):
    return E.status_counts(E.enrich(titled_chunks(spark, d), calls=ONE_BY_ONE).withColumn("status", F.when(F.col("error").isNull(), "success").otherwise("failed")))


@query("incremental_anti", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental(spark, d):
    return I.unprocessed(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), ["doc_id"])


@query("hash_cache_anti", "SELECT doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents JOIN labels USING (doc_id))")
def cached(spark, d):
    docs = table(spark, d, "documents")
    done = docs.join(table(spark, d, "labels"), "doc_id").select(F.sha2("text", 256).alias("doc_hash"))
    return I.by_content(docs.select("doc_id", "text"), done, "text").select("doc_id")


@query("trim_strings", r"""SELECT doc_id, source AS a, source || '|' || lang AS b, lang AS c, ' k ' AS k, source AS v FROM documents""")
def trimmed(spark, d):
    pad = lambda c: F.concat(F.lit(" \t\u00a0"), F.col(c), F.lit(" \n"))
    raw = table(spark, d, "documents").select("doc_id", pad("source").alias("a"), F.array(F.struct(pad("source").alias("x")), F.struct(pad("lang").alias("x"))).alias("b"), F.struct(F.struct(pad("lang").alias("z")).alias("y")).alias("c"), F.create_map(F.lit(" k "), pad("source")).alias("m"))
    t = T.trim_table(raw)
    return t.select("doc_id", "a", F.array_join(F.transform("b", lambda x: x["x"]), "|").alias("b"), F.col("c.y.z").alias("c"), F.map_keys("m")[0].alias("k"), F.map_values("m")[0].alias("v"))


@query("iso_dates", """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '2024-03-05 00:00:00' WHEN 1 THEN '2024-03-05 10:20:30' ELSE '1970-01-01 00:00:00' END AS day FROM documents""")
def iso_dates(spark, d):
    c = F.expr("CASE doc_id % 4 WHEN 0 THEN '2024-03-05' WHEN 1 THEN '2024-03-05T10:20:30' WHEN 2 THEN 'May 2024' END")
    return table(spark, d, "documents").select("doc_id", F.date_format(D.iso_or_default(c), "yyyy-MM-dd HH:mm:ss").alias("day"))


@query("state_update", "SELECT doc_id FROM labels UNION SELECT doc_id FROM documents")
def state(spark, d):
    return I.state_update(table(spark, d, "labels").select("doc_id"), table(spark, d, "documents"))


_FILES = "f AS (SELECT source || '-' || lang AS base, CASE doc_id % 3 WHEN 0 THEN '.docx' WHEN 1 THEN '.pdf' ELSE '.txt' END AS ext, '/in/' || lpad(doc_id::VARCHAR, 8, '0') AS path FROM documents)"


@query("dedupe_priority", f"WITH {_FILES} SELECT base, ext, path FROM f QUALIFY row_number() OVER (PARTITION BY base ORDER BY ext = '.pdf' DESC, path) = 1")
def dedupe(spark, d):
    f = table(spark, d, "documents").select(F.concat_ws("-", "source", "lang").alias("base"), F.expr("CASE doc_id % 3 WHEN 0 THEN '.docx' WHEN 1 THEN '.pdf' ELSE '.txt' END").alias("ext"), F.concat(F.lit("/in/"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("path"))
    return I.dedupe_priority(f)


@query("split_parts", "SELECT doc_id, ((n_chars - 1) // 500 + 1)::INT AS parts, (doc_id // 20 // 7 + 1)::INT AS part FROM documents")
def parts(spark, d):
    return table(spark, d, "documents").select("doc_id", I.part_number(F.col("n_chars"), 500).alias("parts"), I.part_number(F.expr("doc_id div 20 + 1"), 7).alias("part"))


@query("head_n_lines", "SELECT doc_id AS file, i - 1 AS line_no, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE i <= 3")
def head(spark, d):
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return I.head_lines(lines, 3).withColumn("line_no", F.col("line_no").cast("long"))


# graph: conversations as documents, turns as pages, a turn's capitalised words as entities
_G = r"""p AS (SELECT conv_id, turn, list_filter(regexp_extract_all(text, '\b[A-Z][a-z]+'), lambda x: x <> 'The') AS es FROM conversations),
m AS (SELECT DISTINCT conv_id, turn, unnest(es) AS name FROM p)"""


def graph_docs(spark, d):
    c = table(spark, d, "conversations")
    names = F.transform(F.regexp_extract_all("text", F.lit(r"\b[A-Z][a-z]+"), 0), lambda x: F.when(x == "The", "").otherwise(x))
    c = c.select("conv_id", F.struct(F.col("turn").alias("page_number"), names.alias("entities")).alias("p"))
    return c.groupBy(F.col("conv_id").alias("document_id")).agg(F.collect_list("p").alias("pages")).withColumn("source_file", F.lit("f"))


@query("graph_nodes", f"WITH {_G} SELECT conv_id::VARCHAR AS id, 'Document' AS label FROM conversations UNION SELECT conv_id || '_page_' || turn, 'Page' FROM conversations UNION SELECT name, 'Entity' FROM m")
def nodes(spark, d):
    return G.nodes(graph_docs(spark, d))


@query("graph_edges", f"WITH {_G} SELECT conv_id::VARCHAR AS src, conv_id || '_page_' || turn AS dst, 'HAS_PAGE' AS type FROM conversations UNION SELECT conv_id || '_page_' || turn, name, 'MENTIONS' FROM m")
def edges(spark, d):
    return G.edges(graph_docs(spark, d))


@query("entity_explode", f"WITH {_G} SELECT name, count(*) AS n FROM (SELECT unnest(es) AS name FROM p) GROUP BY name")
def entities(spark, d):
    return G.entities(graph_docs(spark, d)).groupBy("name").agg(F.count("*").alias("n"))


@query("graph_merge", f"WITH {_G} SELECT 'node' AS kind, id, label AS what FROM (SELECT conv_id::VARCHAR AS id, 'Document' AS label FROM conversations UNION SELECT conv_id || '_page_' || turn, 'Page' FROM conversations UNION SELECT name, 'Entity' FROM m UNION SELECT 'old', 'Document') UNION ALL SELECT 'edge', src || '>' || dst, type FROM (SELECT conv_id::VARCHAR AS src, conv_id || '_page_' || turn AS dst, 'HAS_PAGE' AS type FROM conversations UNION SELECT conv_id || '_page_' || turn, name, 'MENTIONS' FROM m)")
def graph_merge(spark, d):
    """Half of the documents are in the graph already, with a node of no document here and an edge whose page isn't there; all are merged."""
    docs = graph_docs(spark, d)
    half = docs.filter("document_id % 2 = 0")
    old = spark.createDataFrame([("old", "Document")], "id string, label string")
    loose = spark.createDataFrame([("old", "old_page_9", "HAS_PAGE")], "src string, dst string, type string")
    n, e = G.merge(G.nodes(half).unionByName(old), G.edges(half).unionByName(loose), docs)
    return n.select(F.lit("node").alias("kind"), "id", F.col("label").alias("what")).unionByName(e.select(F.lit("edge").alias("kind"), F.concat("src", F.lit(">"), "dst").alias("id"), F.col("type").alias("what")))


# evaluation: quality labels against a rule on the number of characters
_P = "g AS (SELECT doc_id AS file, CASE quality WHEN 1 THEN 'good' ELSE 'bad' END AS truth, CASE WHEN n_chars < 200 THEN 'short' WHEN n_chars % 3 = 0 THEN 'bad' ELSE 'good' END AS guess FROM labels JOIN documents USING (doc_id))"


def label_sides(spark, d):
    golden = table(spark, d, "labels").select(F.col("doc_id").alias("file"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"))
    guess = table(spark, d, "documents").select(F.col("doc_id").alias("file"), F.expr("CASE WHEN n_chars < 200 THEN 'short' WHEN n_chars % 3 = 0 THEN 'bad' ELSE 'good' END").alias("label"))
    return golden, guess


@query("eval_join", f"WITH {_P} SELECT file, truth, guess FROM g")
def eval_join(spark, d):
    return V.join_labels(*label_sides(spark, d))


@query("label_intersect", "SELECT doc_id AS file FROM labels INTERSECT SELECT doc_id FROM documents WHERE n_chars > 500")
def intersect(spark, d):
    golden, guess = label_sides(spark, d)
    return golden.select("file").intersect(table(spark, d, "documents").filter("n_chars > 500").select("doc_id"))


_PER = f"""{_P}, x AS (SELECT label, count(*) FILTER (truth = label AND guess = label) AS tp, count(*) FILTER (truth = label) AS support, count(*) FILTER (guess = label) AS guessed FROM g, (SELECT truth AS label FROM g UNION SELECT guess FROM g) GROUP BY label),
r AS (SELECT label, support, tp, CASE WHEN guessed > 0 THEN tp / guessed ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM x),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM r)"""


@query("classification_report", f"""WITH {_PER} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
 SELECT label, precision, recall, f1, support FROM f UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support)::BIGINT FROM f
 UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM f
 UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM f)""")
def report(spark, d):
    r = V.report(V.join_labels(*label_sides(spark, d)))
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("label_order", f"WITH {_P}, k AS (SELECT truth AS label FROM g UNION SELECT guess FROM g) SELECT label, row_number() OVER (ORDER BY label)::INT AS nth FROM k")
def label_order(spark, d):
    ls = V.labels(V.join_labels(*label_sides(spark, d))).agg(F.array_sort(F.collect_list("label")).alias("ls"))
    return ls.select(F.posexplode("ls").alias("nth", "label")).select("label", (F.col("nth") + 1).alias("nth"))


@query("confusion_matrix", f"WITH {_P}, k AS (SELECT truth AS label FROM g UNION SELECT guess FROM g) SELECT a.label AS truth, b.label AS guess, count(g.file) AS n FROM k a CROSS JOIN k b LEFT JOIN g ON g.truth = a.label AND g.guess = b.label GROUP BY ALL")
def confusion(spark, d):
    return V.confusion(V.join_labels(*label_sides(spark, d)))

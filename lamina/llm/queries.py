"""Queries of the operators of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, hard_negatives, katz, line_dedup, mixing, packing, pii, quality, sharding, simhash, substring_dedup, url_filters


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document's text when later repeats of passages are deleted, as a digest."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.octet_length("text").cast("long").alias("kept_bytes"), F.sha2("text", 256).alias("kept_sha256"))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under a model of those whose crc32(doc_id) mod 7 is not 2."""
    held = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 7 == 2
    return katz.score(table(spark, sf_dir, "documents"), held)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 under the law `rows`."""
    out = sharding.shard(table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "ring_shard", "hops")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rule, and the robust outlier verdict."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id of its near-duplicate group."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without bytes in repeated 400-byte strings, as a digest."""
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def tokenizer_file() -> str:
    """Where the public byte-level BPE file is; asked for here so that the rest imports without it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the host rules, else by the default globs."""
    return url_filters.filter_urls(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed, sources weighing 1, 2, 3 in turn, at most 3 epochs each."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "repeats", "part")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    out = pii.find(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(k) for k in pii.KINDS]
    return out.select("doc_id", *counts, F.sha2(pii.shown(F.col("base")), 256).alias("base_sha256"), pii.shown(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector first takes the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


_OP1 = r"""
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
s AS (SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
             row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p, count(*) OVER (PARTITION BY doc_id) AS n,
             coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), 1000000000) AS next_i
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
g AS (SELECT doc_id, p, 3 AS k, n, string_agg(line, chr(10)) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS gram FROM s
      UNION ALL SELECT doc_id, p, 1, n, line FROM s WHERE words >= 50),
later AS (SELECT doc_id, p, k FROM g WHERE p + k - 1 <= n QUALIFY row_number() OVER (PARTITION BY k, gram ORDER BY doc_id, p) > 1),
dead AS (SELECT DISTINCT s.doc_id, s.p, s.i, s.next_i FROM s JOIN later ON later.doc_id = s.doc_id AND s.p BETWEEN later.p AND later.p + later.k - 1),
runs AS (SELECT doc_id, count(*) AS n_runs FROM (SELECT doc_id, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM dead GROUP BY doc_id, p) GROUP BY doc_id, run),
n_runs AS (SELECT doc_id, count(*) AS n_runs FROM runs GROUP BY doc_id),
marked AS (SELECT l.doc_id, l.i, l.line, bool_or(dead.p IS NOT NULL) AS gone FROM l LEFT JOIN dead ON dead.doc_id = l.doc_id AND l.i >= dead.i AND l.i < dead.next_i GROUP BY ALL),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_runs, 0) AS n_runs,
       strlen(kept.text)::BIGINT AS kept_bytes, sha256(kept.text) AS kept_sha256
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n_runs ON n_runs.doc_id = d.doc_id
"""

_OP9 = r"""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query FROM u),
rules(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit AS (SELECT s.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS rverdict
        FROM s JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY s.page_id)
SELECT s.page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN rverdict
            WHEN EXISTS (SELECT 1 FROM globs WHERE c.address GLOB globs.g) THEN 'block' ELSE 'allow' END AS verdict
FROM s JOIN c ON c.page_id = s.page_id LEFT JOIN fit ON fit.page_id = s.page_id
"""


def _plain(x: str) -> str:
    """SQL that undoes escapes of unreserved characters."""
    for c in url_filters.UNRESERVED:
        x = f"regexp_replace({x}, '(?i)%{ord(c):02x}', '{c}', 'g')"
    return x


_OP9 = _OP9.replace("fit AS (", f"""c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]+$', '') || regexp_replace({_plain('path')}, '/+', '/', 'g') || {_plain('query')} AS address FROM s),
globs(g) AS (VALUES {', '.join(f"('{g}')" for g in url_filters.DEFAULT_BLOCK)}),
fit AS (""")

_OP10 = r"""
WITH d AS (SELECT doc_id, source, md5(concat_ws('|', '7', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS h, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [1.0, 2.0, 3.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM d GROUP BY source),
o AS (SELECT *, 3.0::DOUBLE * source_size AS cap, sum(source_size) OVER ()::DOUBLE AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / sum(weight) OVER after AS level FROM o WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), after AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
f AS (SELECT *, max(level) FILTER (level * weight <= cap) OVER () AS best FROM l),
t AS (SELECT source, source_size, coalesce(least(best * weight, cap), cap) AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS repeats FROM t),
c AS (SELECT *, floor(target - repeats * source_size)::BIGINT AS cut FROM p),
r AS (SELECT doc_id, size, source_size, target, repeats, cut, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN c ON c.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target, repeats * size + greatest(0, least(size, cut - before))::BIGINT AS taken, repeats, greatest(0, least(size, cut - before))::BIGINT AS part FROM r
"""


_OP12 = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id, v.label, list_inner_product(a.c, v.c)::BIGINT AS score FROM v a JOIN v ON v.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_katz, op3_sharding, op4_embedding_dedup, op5_quality_rules, op6_simhash, op7_substring_dedup, op8_packing, op9_url_filters, op10_mixing, op11_pii, op12_hard_negatives, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": _OP1, "op9_url_filters": _OP9, "op10_mixing": _OP10, "op12_hard_negatives": _OP12}

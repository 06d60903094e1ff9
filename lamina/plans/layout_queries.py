"""Queries of layout and structure. A source stands for a document and each of its texts for a page, a line for a block."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import layout as L
from ..operators import quality as Q
from ..operators import structure as S
from .registry import query, table

_B = """b AS (
  SELECT source AS doc_id, 1 + doc_id // 20 AS page, i AS ord, line AS text, 40.0 + 20.0 * ((i - 1) % 38) AS y0
  FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
  UNION ALL SELECT source, 1 + doc_id // 20, 0, 'Report of ' || source, 20.0 FROM documents
  UNION ALL SELECT source, 1 + doc_id // 20, 100000, 'Internal draft', 815.0 FROM documents),
f AS (SELECT *, CASE WHEN ord = 1 THEN 'Head' ELSE 'Body' END AS font, CASE WHEN ord = 1 AND page % 5 = 0 THEN 18.0 WHEN ord = 1 THEN 14.0 ELSE 10.0 END AS size, 0 AS flags FROM b)"""


def blocks(spark, d):
    docs = table(spark, d, "documents").withColumn("page", F.expr("1 + doc_id div 20"))
    b = docs.select(F.col("source").alias("doc_id"), "page", F.posexplode(F.split("text", "\n")).alias("i", "text")).withColumn("ord", F.col("i") + 1)
    b = b.select("doc_id", "page", "ord", "text", (40.0 + 20.0 * (F.col("i") % 38)).alias("y0"))
    top = docs.select(F.col("source").alias("doc_id"), "page", F.lit(0).alias("ord"), F.concat(F.lit("Report of "), "source").alias("text"), F.lit(20.0).alias("y0"))
    end = docs.select(F.col("source").alias("doc_id"), "page", F.lit(100000).alias("ord"), F.lit("Internal draft").alias("text"), F.lit(815.0).alias("y0"))
    b = b.unionByName(top).unionByName(end)
    size = F.when((F.col("ord") == 1) & (F.col("page") % 5 == 0), 18.0).when(F.col("ord") == 1, 14.0).otherwise(10.0)
    return b.withColumns({"font": F.when(F.col("ord") == 1, "Head").otherwise("Body"), "size": size, "flags": F.lit(0), "x0": F.lit(50.0), "x1": F.lit(550.0), "y1": F.col("y0") + 15.0, "n_lines": F.lit(1)})


def toc(spark, d):
    b = blocks(spark, d).filter("ord = 1 and page % 5 = 0 and length(text) < 200")
    t = b.select("doc_id", F.col("page").alias("nth"), "text", F.lit(1).alias("level"), "page")
    return t.unionByName(t.select("doc_id", (F.col("nth") + 1000).alias("nth"), F.lit("Missing entry").alias("text"), F.lit(2).alias("level"), "page"))


_TOC = """t AS (SELECT doc_id, page AS nth, text, 1 AS level, page FROM f WHERE ord = 1 AND page % 5 = 0 AND length(text) < 200
  UNION ALL SELECT doc_id, page + 1000, 'Missing entry', 2, page FROM f WHERE ord = 1 AND page % 5 = 0 AND length(text) < 200)"""


@query("font_profile", f"WITH {_B} SELECT doc_id, font, size::DOUBLE AS size, flags, count(*) AS n FROM f GROUP BY ALL")
def fonts(spark, d):
    return L.font_profile(blocks(spark, d))


_HEADER = r"length(text) <= 300 AND NOT regexp_matches(text, '^[•*-][\s\p{Z}]|^o ') AND len(regexp_extract_all(text, '\|')) < 3 AND NOT regexp_full_match(text, '\p{Nd}+') AND NOT regexp_full_match(lower(text), '[ivx]+') AND regexp_matches(text, '[a-zA-Z]')"
_RARE = f"rare AS (SELECT doc_id, font, size, flags FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS total FROM (SELECT doc_id, font, size, flags, count(*) AS n FROM f GROUP BY ALL)) WHERE n / total < 0.05 AND size > 10.5), c AS (SELECT f.* FROM f JOIN rare USING (doc_id, font, size, flags) WHERE {_HEADER})"


@query("rare_font_headers", f"WITH {_B}, {_RARE} SELECT doc_id, page, ord, md5(text) AS h FROM c")
def rare(spark, d):
    b = blocks(spark, d)
    return L.rare_font_headers(b, b).select("doc_id", "page", "ord", F.md5("text").alias("h"))


@query("font_levels", f"WITH {_B}, {_TOC} SELECT f.doc_id, page, ord, size::DOUBLE AS size, (dense_rank() OVER (PARTITION BY f.doc_id ORDER BY size DESC) + coalesce(m, 0))::INT AS level FROM f LEFT JOIN (SELECT doc_id, max(level) AS m FROM t GROUP BY doc_id) x ON x.doc_id = f.doc_id WHERE ord = 1")
def levels(spark, d):
    return L.font_levels(blocks(spark, d).filter("ord = 1"), toc(spark, d)).select("doc_id", "page", "ord", "size", F.col("level").cast("int").alias("level"))


_REP = "rep AS (SELECT doc_id, text, CASE WHEN avg(y0) < 842 * 0.15 THEN 'header' WHEN avg(y0) > 842 * 0.85 THEN 'footer' END AS kind FROM (SELECT *, count(DISTINCT page) OVER (PARTITION BY doc_id) AS n_pages FROM b) WHERE length(text) BETWEEN 1 AND 149 GROUP BY doc_id, text, n_pages HAVING floor(n_pages * 0.6) > 1 AND count(*) > floor(n_pages * 0.6) AND length(text) < 50 AND (avg(y0) < 842 * 0.15 OR avg(y0) > 842 * 0.85))"


def repeated(spark, d):
    b = blocks(spark, d)
    n = b.groupBy("doc_id").agg(F.countDistinct("page").alias("n_pages"))
    return L.repeated_lines(b.join(n, "doc_id").withColumn("height", F.lit(842.0)))


@query("repeated_lines", f"WITH {_B}, {_REP} SELECT doc_id, text, kind FROM rep")
def rep(spark, d):
    return repeated(spark, d)


@query("strip_repeated", f"WITH {_B}, {_REP} SELECT b.doc_id, count(*) AS n FROM b ANTI JOIN rep ON rep.doc_id = b.doc_id AND rep.text = b.text GROUP BY b.doc_id")
def stripped(spark, d):
    return L.strip_repeated(blocks(spark, d), repeated(spark, d)).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("toc_page", """
WITH p AS (SELECT source AS doc_id, 1 + doc_id // 20 AS page, CASE WHEN doc_id % 77 = 3 THEN 'Table of Contents ' || text WHEN doc_id % 31 = 5 THEN 'Contents ' || text ELSE text END AS text FROM documents)
SELECT doc_id, min(page) AS page FROM p WHERE page <= 10 AND (contains(lower(text), 'table of contents') OR (contains(lower(text), 'contents') AND length(text) < 2000)) GROUP BY doc_id""")
def tocs(spark, d):
    text = F.expr("CASE WHEN doc_id % 77 = 3 THEN concat('Table of Contents ', text) WHEN doc_id % 31 = 5 THEN concat('Contents ', text) ELSE text END")
    return L.toc_page(table(spark, d, "documents").select(F.col("source").alias("doc_id"), F.expr("1 + doc_id div 20").alias("page"), text.alias("text")))


@query("toc_resolve", f"WITH {_B}, {_TOC}, m AS (SELECT doc_id, page, text, arg_min(y0, ord) AS y0 FROM f WHERE length(text) > 5 AND length(text) < 200 GROUP BY ALL) SELECT t.doc_id, t.nth, t.level, t.page, m.y0::DOUBLE AS y0, md5(t.text) AS h FROM t LEFT JOIN m USING (doc_id, page, text)")
def resolve(spark, d):
    return L.toc_resolve(toc(spark, d), blocks(spark, d)).select("doc_id", "nth", "level", "page", "y0", F.md5("text").alias("h"))


@query("spatial_anti", f"WITH {_B} SELECT doc_id, page, count(*) AS n FROM f WHERE NOT (page % 3 = 0 AND y0 < 200 AND y0 + 15 > 100) GROUP BY ALL")
def spatial(spark, d):
    tables = table(spark, d, "documents").select(F.col("source").alias("doc_id"), F.expr("1 + doc_id div 20").alias("page"), F.lit(0.0).alias("x0"), F.lit(100.0).alias("y0"), F.lit(600.0).alias("x1"), F.lit(200.0).alias("y1")).filter("page % 3 = 0")
    return L.spatial_anti(blocks(spark, d), tables).groupBy("doc_id", "page").agg(F.count("*").alias("n"))


# structure: every third line of a text is a heading
_S = """l AS (SELECT doc_id, i - 1 AS ord, line AS text, 1 + (i - 1) // 6 AS page, 50.0 + 100.0 * ((i - 1) % 6) AS y0, 70.0 + 100.0 * ((i - 1) % 6) AS y1, (1 + ((i - 1) // 3 + doc_id) % 3)::INT AS level
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
h AS (SELECT doc_id, ord, text, level, page, y0, y1 FROM l WHERE ord % 3 = 0)"""


def headed(spark, d):
    """(headings, all blocks)."""
    b = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    b = b.withColumns({"page": F.expr("1 + ord div 6"), "y0": 50.0 + 100.0 * (F.col("ord") % 6), "y1": 70.0 + 100.0 * (F.col("ord") % 6), "level": F.expr("cast(1 + (ord div 3 + doc_id) % 3 AS int)")})
    return b.filter("ord % 3 = 0"), b


@query("leaf_headers", f"WITH {_S} SELECT doc_id, ord, coalesce(lead(level) OVER (PARTITION BY doc_id ORDER BY ord) <= level, true) AS leaf FROM h")
def leaves(spark, d):
    return S.leaf_headers(headed(spark, d)[0]).select("doc_id", "ord", "leaf")


_PATHS = """parents AS (SELECT a.doc_id, a.ord, a.text, max(g.ord) AS parent FROM h a LEFT JOIN h g ON g.doc_id = a.doc_id AND g.ord < a.ord AND g.level < a.level GROUP BY ALL),
paths AS (SELECT doc_id, ord, [text] AS path FROM parents WHERE parent IS NULL UNION ALL SELECT p.doc_id, p.ord, list_append(r.path, p.text) FROM parents p JOIN paths r ON p.doc_id = r.doc_id AND p.parent = r.ord)"""


@query("section_hierarchy", f"WITH RECURSIVE {_S}, {_PATHS} SELECT doc_id, ord, array_to_string(path, ' > ') AS path FROM paths")
def hierarchy(spark, d):
    return S.section_hierarchy(headed(spark, d)[0]).select("doc_id", "ord", F.array_join("path", " > ").alias("path"))


@query("merge_headers", f"""
WITH RECURSIVE {_S},
c AS (SELECT doc_id, page, y0, text, level * 2 AS level, ord % 5 = 3 AS dummy, ord AS tie FROM h UNION ALL SELECT doc_id, page, y0 + 2, text, level * 2, ord % 5 = 3, ord + 1 FROM h WHERE ord % 2 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page, CASE WHEN dummy THEN '-infinity'::DOUBLE ELSE y0 END, tie) AS i FROM c),
f AS (
  SELECT doc_id, 0::BIGINT AS i, []::INT[] AS stack, NULL::VARCHAR AS text, NULL::INT AS level, NULL::BIGINT AS page, NULL::DOUBLE AS y0, false AS kept FROM documents
  UNION ALL
  SELECT doc_id, i, CASE WHEN same THEN rest ELSE list_append(rest, final) END, CASE WHEN same THEN was ELSE new END, CASE WHEN same THEN l ELSE final END, CASE WHEN same THEN wp ELSE p END, CASE WHEN same THEN wy ELSE y END, NOT same
  FROM (SELECT *, coalesce(was = new AND wp = p AND abs(wy - y) < 5, false) AS same, CASE WHEN dummy OR own > implied + 2 THEN implied ELSE own END::INT AS final FROM (
    SELECT f.doc_id, o.i, f.text AS was, f.level AS l, f.page AS wp, f.y0 AS wy, o.text AS new, o.level AS own, o.page AS p, CASE WHEN o.dummy THEN 0.0 ELSE o.y0 END::DOUBLE AS y, o.dummy,
      list_filter(f.stack, lambda s: s < o.level) AS rest, coalesce(list_max(list_filter(f.stack, lambda s: s < o.level)) + 1, 1) AS implied FROM f JOIN o ON o.doc_id = f.doc_id AND o.i = f.i + 1)))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS nth, text, level, page::INT AS page, y0 FROM f WHERE kept""")
def merged(spark, d):
    h = headed(spark, d)[0]
    c = h.select("doc_id", "page", "y0", "text", (F.col("level") * 2).alias("level"), (F.col("ord") % 5 == 3).alias("dummy"), F.col("ord").alias("tie"))
    c = c.unionByName(c.filter("tie % 2 = 0").withColumns({"y0": F.col("y0") + 2.0, "tie": F.col("tie") + 1}))  # near repeats
    return S.merge_headers(c).select("doc_id", "nth", "text", "level", F.col("page").cast("int").alias("page"), "y0")


_ASSIGN = """leaf AS (SELECT *, lead(page) OVER w AS np, lead(y0) OVER w AS ny, lead(level) OVER w AS nl FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
cand AS (SELECT l.doc_id, l.ord, f.ord AS header_ord, max((np IS NOT NULL AND (l.page > np OR (l.page = np AND l.y0 >= ny)))::INT) OVER (PARTITION BY l.doc_id, f.ord ORDER BY l.page, l.ord ROWS UNBOUNDED PRECEDING) AS seen
  FROM l JOIN leaf f ON f.doc_id = l.doc_id AND (l.page > f.page OR (l.page = f.page AND l.y0 >= f.y1)) WHERE nl IS NULL OR nl <= f.level),
a AS (SELECT doc_id, ord, header_ord FROM cand WHERE seen = 0)"""


@query("section_assign", f"WITH {_S}, {_ASSIGN} SELECT * FROM a")
def assign(spark, d):
    return S.section_assign(*headed(spark, d))


@query("section_asof", f"WITH {_S}, {_ASSIGN} SELECT * FROM a")
def asof(spark, d):
    return S.section_asof(*headed(spark, d))


@query("section_text", f"WITH {_S}, {_ASSIGN} SELECT a.doc_id, a.header_ord, md5(string_agg(l.text, chr(10) || chr(10) ORDER BY l.page, l.ord)) AS h, string_agg(DISTINCT l.page::VARCHAR, ',' ORDER BY l.page::VARCHAR) AS pages FROM a JOIN l USING (doc_id, ord) GROUP BY ALL")
def sections(spark, d):
    h, b = headed(spark, d)
    t = S.section_text(S.section_assign(h, b), b)
    return t.select("doc_id", "header_ord", F.md5("text").alias("h"), F.array_join(F.array_sort(F.transform("pages", lambda p: p.cast("string"))), ",").alias("pages"))


@query("orphan_blocks", f"WITH {_S}, {_ASSIGN} SELECT l.doc_id, l.ord FROM l ANTI JOIN h ON h.doc_id = l.doc_id AND h.page = l.page AND h.y0 = l.y0 ANTI JOIN a ON a.doc_id = l.doc_id AND a.ord = l.ord")
def orphans(spark, d):
    h, b = headed(spark, d)
    return S.orphan_blocks(b, h, S.section_assign(h, b)).select("doc_id", "ord")


@query("completeness", r"""
WITH c AS (SELECT doc_id, unnest(list_transform(range(0, len(w), 100), lambda i: array_to_string(w[i + 1 : i + 100], ' '))) AS chunk FROM (SELECT doc_id, list_filter(string_split_regex(regexp_replace(text, '[.,]', '', 'g'), '\s+'), lambda x: x <> '') AS w FROM documents)),
s AS (SELECT d.doc_id, length(any_value(d.text)) AS source_chars, coalesce(sum(length(chunk)), 0)::BIGINT AS chunk_chars FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT doc_id, source_chars, chunk_chars, round(chunk_chars / source_chars, 6) AS ratio, CASE WHEN chunk_chars / source_chars >= 0.97 THEN 'passed' ELSE 'failed' END AS status FROM s""")
def complete(spark, d):
    docs = table(spark, d, "documents")
    lossy = F.regexp_replace("text", "[.,]", "")  # chunks that have lost some characters
    chunks = docs.select("doc_id", F.explode(T.word_windows(lossy, 100, 0)).alias("text"))
    return Q.completeness(docs.select("doc_id", "text"), chunks, 0.97).withColumn("ratio", F.round("ratio", 6))


@query("section_pages", f"""
WITH {_S}, x AS (SELECT a.*, (SELECT min(g.page) FROM h g WHERE g.doc_id = a.doc_id AND g.ord <> a.ord AND g.level <= a.level AND g.page > a.page) AS stop_page,
  (SELECT min(g.ord) FROM h g WHERE g.doc_id = a.doc_id AND g.ord <> a.ord AND g.level <= a.level AND g.page = a.page AND g.y0 > a.y0) AS stop_ord FROM h a)
SELECT l.doc_id, l.ord, x.ord AS header_ord FROM l JOIN x ON x.doc_id = l.doc_id AND ((l.page = x.page AND l.y0 > x.y0 AND (stop_ord IS NULL OR l.ord < stop_ord)) OR (l.page > x.page AND stop_ord IS NULL AND (stop_page IS NULL OR l.page < stop_page)))""")
def pagewise(spark, d):
    return S.section_pages(*headed(spark, d))


@query("font_order", f"WITH {_B}, p AS (SELECT doc_id, font, size, flags, count(*) AS n FROM f GROUP BY ALL) SELECT doc_id, font, size::DOUBLE AS size, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, font, size, flags)::INT AS rank FROM p")
def font_order(spark, d):
    return L.font_order(L.font_profile(blocks(spark, d))).select("doc_id", "font", "size", "n", "rank")

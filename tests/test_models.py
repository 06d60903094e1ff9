"""Folds and Python-side functions against direct models, and the cases that tables lack."""

import random
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from lamina.functions import dates, jsonx
from lamina.functions import text as T
from lamina.functions.config import Config, resolve_paths
from lamina.operators import enrich, evaluate, graph, layout, predicates, quality, structure, vectors
from lamina.plans.ingestion import chunk_documents
from lamina.sources import scan, sinks


def one(spark, expr, **values):
    df = spark.range(1).withColumns({k: (F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v))) for k, v in values.items()})
    return df.select(expr.alias("x")).first().x


def pack(sentences, size, overlap):
    chunks, cur = [], []
    for s in sentences:
        if cur and len(" ".join(cur)) + len(s) + 1 > size:
            chunks.append(" ".join(cur))
            keep, n = [], 0
            for t in reversed(cur):
                if n + len(t) + 1 >= overlap:
                    break
                n += len(t) + 1
                keep.insert(0, t)
            cur = keep
        cur.append(s)
    return chunks + ([" ".join(cur)] if cur else [])


def test_sentence_packing_equals_model(spark):
    rng = random.Random(1)
    rows = [(i, [chr(97 + rng.randrange(26)) * rng.randrange(1, 40) for _ in range(rng.randrange(0, 25))]) for i in range(200)]
    got = spark.createDataFrame(rows, "id long, s array<string>").select("id", T.sentence_chunks(F.col("s"), 60, 25).alias("c")).collect()
    assert {r.id: r.c for r in got} == {i: pack(s, 60, 25) for i, s in rows}


def test_merge_headers_equals_model(spark):
    rng = random.Random(2)
    docs = {d: [(rng.randrange(1, 4), float(rng.randrange(0, 30)), rng.choice("ab"), rng.randrange(1, 9), rng.random() < 0.2, t) for t in range(rng.randrange(1, 15))] for d in range(60)}
    want = {}
    for d, hs in docs.items():
        stack, out = [], []
        for p, y, text, level, dummy, t in sorted(hs, key=lambda h: (h[0], float("-inf") if h[4] else h[1], h[5])):
            while stack and level <= stack[-1]:
                stack.pop()
            implied = stack[-1] + 1 if stack else 1
            final = implied if dummy or level > implied + 2 else level
            y = 0.0 if dummy else y
            if not (out and out[-1][0] == text and out[-1][2] == p and abs(out[-1][3] - y) < 5):
                out.append((text, final, p, y))
                stack.append(final)
        want[d] = out
    df = spark.createDataFrame([(d, *h) for d, hs in docs.items() for h in hs], "doc_id long, page int, y0 double, text string, level int, dummy boolean, tie int")
    got = {}
    for r in structure.merge_headers(df).orderBy("doc_id", "nth").collect():
        got.setdefault(r.doc_id, []).append((r.text, r.level, r.page, r.y0))
    assert got == want


def test_section_assign_equals_model(spark):
    rng = random.Random(3)
    heads, blocks, want = [], [], set()
    for d in range(60):
        hs = sorted((rng.randrange(1, 4), float(rng.randrange(0, 100))) for _ in range(rng.randrange(1, 6)))
        hs = [(i, p, y, y + 5, rng.randrange(1, 4)) for i, (p, y) in enumerate(hs)]
        bs, n = [], 0
        for p in range(1, 5):
            for _ in range(rng.randrange(0, 6)):  # order on a page is not that of y
                bs.append((n, p, float(rng.randrange(0, 110))))
                n += 1
        heads += [(d, *h[:1], f"h{h[0]}", h[4], *h[1:4]) for h in hs]
        blocks += [(d, *b, "t") for b in bs]
        for k, (i, p, _, y1, level) in enumerate(hs):
            nxt = hs[k + 1] if k + 1 < len(hs) else None
            if nxt and nxt[4] > level:
                continue
            for o, bp, by in bs:
                if (bp, by) < (p, y1):
                    continue
                if nxt and (bp, by) >= (nxt[1], nxt[2]):
                    break
                want.add((d, o, i))
    h = spark.createDataFrame(heads, "doc_id long, ord int, text string, level int, page int, y0 double, y1 double")
    b = spark.createDataFrame(blocks, "doc_id long, ord int, page int, y0 double, text string")
    got = [tuple(r) for r in structure.section_assign(h, b).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # every block is a section's, an orphan, or stands where a heading does
    rest = structure.orphan_blocks(b, h, structure.section_assign(h, b)).count()
    at = b.join(h.select("doc_id", "page", "y0").distinct(), ["doc_id", "page", "y0"], "left_semi")
    at = at.join(structure.section_assign(h, b), ["doc_id", "ord"], "left_anti").count()
    assert len(got) + rest + at == b.count()


def test_section_asof_equals_range_join(spark):
    """Headings in order of place, some over one another, some without a place; blocks in any order, level with headings, on pages without one."""
    rng = random.Random(8)
    heads, blocks = [], []
    for d in range(120):
        hs = sorted((rng.randrange(1, 5), float(rng.choice([0, rng.randrange(0, 60)]))) for _ in range(rng.randrange(0, 7)))
        heads += [(d, i, f"h{i}", rng.randrange(1, 4), p, y, y + rng.choice([0.0, 3.0, 20.0])) for i, (p, y) in enumerate(hs)]
        n = rng.randrange(0, 25)
        blocks += [(d, o, p, float(rng.randrange(0, 70)), f"t{o}") for o, p in enumerate(sorted(rng.randrange(1, 7) for _ in range(n)))]
        blocks += [(d, n + k, p, y, "heading") for k, (p, y) in enumerate(hs) if rng.random() < 0.7]
    h = spark.createDataFrame(heads, "doc_id long, ord int, text string, level int, page int, y0 double, y1 double")
    b = spark.createDataFrame(blocks, "doc_id long, ord int, page int, y0 double, text string")
    for keep_all in (False, True):
        want, got = (sorted((tuple(r) for r in f(h, b, keep_all).collect()), key=str) for f in (structure.section_assign, structure.section_asof))
        assert len(got) > 500 and got == want
    plan = structure.section_asof(h, b)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "sequence(" not in plan
    assert structure.section_asof(h.limit(0), b).count() == 0 and structure.section_asof(h, b.limit(0)).count() == 0


def test_flatten_metadata(spark):
    meta = "named_struct('doc_id', 'd', 'chunk_type', 'table_summary', 'section_path', array('A', 'B'), 'raw_table_content', '|r|', 'semantic_purpose', named_struct('value', 'Efficacy Results', 'confidence', 0.9D, 'justification', 'j'), 'persona_relevance_scores', map('health_economist', named_struct('score', 1D, 'justification', 'j')), 'typed_entities', array(named_struct('name', 'n', 'type', 'DRUG')), 'quality_assessment', cast(null as struct<confidence:double,is_ambiguous:boolean,justification:string>))"
    df = spark.range(1).select(F.lit("c1").alias("chunk_id"), F.lit("summary").alias("text"), F.expr(meta).alias("metadata"), F.lit("2024-11-01").cast("timestamp").alias("published"))
    r = vectors.flatten_metadata(df).first()
    assert (r.source_content, r.persona_health_economist_score, r.persona_clinical_analyst_score) == ("|r|", 1.0, None)
    assert (r.quality_assessment_confidence, r.quality_assessment_is_ambiguous, r.section_path, r.mentioned_entities) == (0.0, True, "A > B", ["n"])


def test_text_edges(spark):
    assert one(spark, T.normalize_text(F.col("t")), t="a\r\n\r\n\r\n\r\nb \t c\n --- Page 3 --- \nd CONFIDENTIAL Page 1 of 2") == "a\n\nb c\nd"
    assert one(spark, T.title_guess(F.col("t")), t="  \n" + "w " * 16 + "\nShort one") == "Short one"
    assert one(spark, T.title_guess(F.col("t")), t="") == T.UNTITLED
    assert one(spark, T.chunk_type_snake(F.col("t")), t="Sponsor's Justification") == "sponsor's_justification"
    assert one(spark, T.clean_path(F.col("p")), p=["a", "a", "b", "a"]) == ["a", "b", "a"]
    assert one(spark, T.word_windows(F.col("t"), 4, 1), t="a b c d e") == ["a b c d", "d e"]
    assert one(spark, T.word_windows(F.col("t"), 4, 1), t=" ") == []
    with pytest.raises(ValueError):
        T.word_windows(F.col("t"), 4, 4)
    assert one(spark, predicates.low_value(F.col("t")), t="x" * 19) and not one(spark, predicates.low_value(F.col("t")), t="x" * 20)


@pytest.mark.parametrize("text,want", [("03/04/2021", date(2021, 3, 4)), ("25/12/2024", date(2024, 12, 25)), ("Sept 2, 2024", date(2024, 9, 2)), ("2024-1-5", date(2024, 1, 5)), ("1-2-24", date(2024, 1, 2)), ("4 March 2021", date(2021, 3, 4)), ("soon", None), ("31/31/2020", None)])
def test_lenient_dates(spark, text, want):
    assert one(spark, dates.lenient_date(F.col("t")), t=text) == want


@pytest.mark.parametrize("text,want", [("x-11-2022", date(2022, 11, 1)), ("x-nov-2024", date(2024, 11, 1)), ("x-March-2025", date(2025, 3, 1)), ("x-13-2022", date(2022, 1, 1)), ("guide 2016 v5", date(2016, 1, 1)), ("none", date(1970, 1, 1))])
def test_docid_dates(spark, text, want):
    assert one(spark, dates.docid_date(F.col("t"))[0], t=text) == want


def test_json_functions():
    assert jsonx.first_object('x {bad} then {"a": {"b": 1}} {"c": 2}') == '{"a": {"b": 1}}'
    assert jsonx.first_object("none") is None
    assert jsonx.repair("```json\n{'a': [1, 2,], 'b': None\n```") is not None
    assert jsonx.repair("no") is None and jsonx.repair(None) is None


def test_validation_order(spark):
    s = "title string, sections array<struct<heading:string>>, pbac_meeting_date string, doc_id string"
    rows = [("", [], None, "d"), ("t", [], None, "d"), ("t", [("",)], "bad", "d"), ("t", [("h",)], None, "d")]
    r = quality.validate_docs(spark.createDataFrame(rows, s)).collect()
    assert [x.status for x in r] == ["error", "error", "success_with_warnings", "success"]
    assert len(r[0].errors) == 1 and len(r[2].warnings) == 2


def test_report_of_nothing(spark):
    df = spark.createDataFrame([], "file string, truth string, guess string")
    assert evaluate.confusion(df).count() == 0 and evaluate.report(df).count() == 3


def test_graph_skips_empty_names(spark):
    df = spark.createDataFrame([("d", "f", [(1, ["x", "", None]), (2, ["x"])])], "document_id string, source_file string, pages array<struct<page_number:int,entities:array<string>>>")
    assert graph.nodes(df).count() == 4 and graph.edges(df).count() == 4


def test_spatial_and_repeated(spark):
    b = spark.createDataFrame([("d", p, o, "Foot" if o else f"t{p}", 0.0, 820.0 if o else 300.0, 9.0, 830.0 if o else 310.0, 4, 842.0) for p in range(1, 5) for o in (0, 1)], "doc_id string, page int, ord int, text string, x0 double, y0 double, x1 double, y1 double, n_pages int, height double")
    assert [tuple(r) for r in layout.repeated_lines(b).collect()] == [("d", "Foot", "footer")]
    t = spark.createDataFrame([("d", 1, 5.0, 305.0, 8.0, 306.0)], "doc_id string, page int, x0 double, y0 double, x1 double, y1 double")
    assert layout.spatial_anti(b, t).count() == 7


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a b.txt").write_bytes("é\xff".encode("latin-1") + b" ok")
    (tmp_path / "in" / "sub" / "c.XYZ").write_text("x")
    with zipfile.ZipFile(tmp_path / "in" / "d.docx", "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>one</w:t></w:p><w:p><w:t>two</w:t></w:p></w:document>')
    (tmp_path / "in" / "e.pdf").write_bytes(b"not a pdf")
    good, bad = scan.texts(scan.files(spark, str(tmp_path / "in")))
    got = {r.path.rsplit("/", 1)[1]: r.text for r in good.collect()}
    assert got["d.docx"] == "one\ntwo" and len(got) == 2 and bad.count() == 2
    inv = {r.file_name: r.relative_path for r in scan.inventory(spark, str(tmp_path / "in")).collect()}
    assert inv["c.XYZ"] == "sub/c.XYZ"
    assert scan.supported(spark, str(tmp_path / "in")).count() == 3
    with pytest.raises(ValueError):
        sinks.save(good, str(tmp_path / "out"), "doc")
    v = spark.createDataFrame([(1, 1, "f", "c1", "n1"), (2, 1, "f", "c2", "n2")], "id long, version int, filename string, chunk_id string, namespace string")
    table, state = str(tmp_path / "v"), str(tmp_path / "s")
    assert sinks.load_vectors(v, table, state) == 2 and sinks.load_vectors(v, table, state) == 0
    more = spark.createDataFrame([(1, 2, "f", "c3", "n1")], v.schema)
    assert sinks.load_vectors(more, table, state) == 1
    assert sorted((r.id, r.version) for r in sinks.read_table(spark, table).collect()) == [(1, 2), (2, 1)]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('[{"k": 1}, {"k": 2}]')
    (tmp_path / "j" / "b.json").write_text("{oops")
    rows, corrupt = scan.json_files(spark, str(tmp_path / "j"), "k int")
    assert sorted(r.k for r in rows.collect()) == [1, 2] and corrupt.count() == 1


def test_chunk_ids_are_stable_and_unstructured_documents_work(spark):
    h = spark.createDataFrame([(1, 0, "Results", 1, 1, 10.0, 20.0)], "doc_id long, ord int, text string, level int, page int, y0 double, y1 double")
    b = spark.createDataFrame([(1, 0, 1, 10.0, "Results"), (1, 1, 1, 30.0, "One. Two."), (2, 0, 1, 5.0, "Plain.")], "doc_id long, ord int, page int, y0 double, text string")
    a, c = (sorted(tuple(r) for r in chunk_documents(h, b).select("chunk_id", "doc_id", F.array_join("section_path", ">"), "text").collect()) for _ in range(2))
    assert a == c and {(r[1], r[2]) for r in a} == {(1, "Results"), (2, "Unstructured Document")}


def test_config():
    c = Config.from_dict({"default_chunking": {"chunk_size": 7}, "validation_rules": {"completeness_threshold": 0.5}})
    assert c.default_chunk == (7, 200) and c.completeness == 0.5 and c.page_threshold == 0.6
    assert resolve_paths({"a": ["${root}/x"]}, "/r") == {"a": ["/r/x"]}

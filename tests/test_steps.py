"""Sinks with their failures, steps around models, and text and date functions on cases that the tables lack."""

import json

import pytest
from pyspark.sql import functions as F

from lamina.functions import config, dates
from lamina.functions import text as T
from lamina.operators import enrich, evaluate, graph, models, quality, structure, vectors
from lamina.plans.ingestion import chunk_documents, table_chunks
from lamina.sources import scan, sinks


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_vector_table_survives_a_broken_load(spark, tmp_path):
    path = f"file://{tmp_path}/index/v"
    sinks.create_table(spark, path, 2)
    with pytest.raises(FileExistsError):
        sinks.create_table(spark, path, 2)
    assert sinks.list_tables(spark, f"file://{tmp_path}/index") == ["v"] and sinks.read_table(spark, path).count() == 0
    put = lambda rows: sinks.write_upsert(spark.createDataFrame(rows, "id string, namespace string, version int, x int"), path, ["namespace", "id"])
    read = lambda: rows_of(sinks.read_table(spark, path).select("namespace", "id", "x"))
    put([("a", "1", 1, 10), ("b", "1", 1, 11), ("a", "2", 1, 12)])
    put([("a", "1", 2, 20), ("c", "1", 1, 13)])
    want = [("1", "a", 20), ("1", "b", 11), ("1", "c", 13), ("2", "a", 12)]
    assert read() == want
    # data without its manifest, and a manifest without its mark: a load that died
    spark.createDataFrame([("z", 1, 99, "rdead", "1")], "id string, version int, x int, run string, namespace string").write.mode("append").partitionBy("run", "namespace").parquet(f"{path}/data")
    (tmp_path / "index/v/manifest/99").mkdir()
    assert read() == want
    assert sinks.vacuum(spark, path) >= 1 and read() == want
    sinks.clear_table(spark, path, "1")
    assert read() == [("2", "a", 12)]
    sinks.clear_table(spark, path)
    assert read() == []
    sinks.drop_table(spark, path)
    assert sinks.list_tables(spark, f"file://{tmp_path}/index") == []


def test_loads_are_idempotent(spark, tmp_path):
    v = spark.createDataFrame([(i, str(i % 2), 1, f"f{i}", i) for i in range(9)], "id int, namespace string, version int, filename string, chunk_id int")
    to = f"file://{tmp_path}/t", f"file://{tmp_path}/s"
    assert [sinks.load_vectors(v.filter("id < 5"), *to), sinks.load_vectors(v, *to), sinks.load_vectors(v, *to)] == [5, 4, 0]
    assert sinks.read_table(spark, to[0]).count() == 9


def test_outputs_only_where_there_are_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id string, x int")
    assert not sinks.save_per_document(empty, f"{tmp_path}/a") and not (tmp_path / "a").exists()
    v = spark.createDataFrame([("a", [1.0]), ("b", []), ("c", None)], "filename string, embedding array<double>")
    assert sinks.save_embeddings(v, f"{tmp_path}/e") and rows_of(spark.read.parquet(f"{tmp_path}/e").select("filename")) == [("a",)]
    assert not sinks.save_embeddings(v.filter("filename <> 'a'"), f"{tmp_path}/f")
    docs = spark.createDataFrame([("a", "success", []), ("b", "error", ["e"])], "doc_id string, status string, errors array<string>")
    left = sinks.save_valid(docs, f"{tmp_path}/v")
    assert [r.doc_id for r in left.collect()] == ["b"] and spark.read.json(f"{tmp_path}/v").count() == 1
    with pytest.raises(ValueError, match="unknown output format"):
        sinks.save(docs, f"{tmp_path}/x", "pkl")


def test_artifacts(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        (tmp_path / "none/x.txt").write_text("x")
        scan.artifacts(spark, f"{tmp_path}/none")
    for d, done in (("a b", "[1]"), ("c", "[]"), ("d", None)):
        (tmp_path / f"in/{d}_artifacts").mkdir(parents=True)
        (tmp_path / f"in/{d}_artifacts/chunks.json").write_text("[{}]")
        if done:
            (tmp_path / f"in/{d}_artifacts/enriched_chunks.json").write_text(done)
    (tmp_path / "in/e_artifacts").mkdir()
    (tmp_path / "in/e_artifacts/other.json").write_text("{}")
    found = scan.artifacts(spark, f"{tmp_path}/in")
    assert rows_of(scan.to_enrich(found)) == [("c",), ("d",)]
    assert rows_of(scan.to_enrich(found, force=True)) == [("a b",), ("c",), ("d",)]


def test_head_files(spark, tmp_path):
    for name in ("a.json", "sub/b.json", "sub/out/c.json", "sub/d.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("1\n2\n3\n4")
    got = rows_of(scan.head_files(spark, f"{tmp_path}", 2, exclude="sub/out"))
    assert got == [("a.json", 0, "1"), ("a.json", 1, "2"), ("sub_b.json", 0, "1"), ("sub_b.json", 1, "2")]


def test_head_files_end(spark, tmp_path):
    """What follows a file's last line end is a line, as string_split() has it; none beyond the first n."""
    texts = {"a.txt": "1\n2\n", "b.txt": "1\n2", "c.txt": "1\n2\n3\n", "d.txt": "\n", "e.txt": "", "f.txt": "\ufeffé\n", "g.txt": "\ufeffé", "h.txt": "1\r\n\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "i.txt").write_bytes(b"\xff\xfe\n")
    got = {}
    for r in scan.head_files(spark, f"{tmp_path}", 3, "*.txt").orderBy("file", "line_no").collect():
        got.setdefault(r.file, []).append((r.line_no, r.line))
    bad = [x for _, x in got.pop("i.txt")]
    assert len(bad) == 2 and bad[1] == ""
    assert {k: [x for _, x in v] for k, v in got.items()} == {k: t.removeprefix("\ufeff").split("\n")[:3] for k, t in texts.items() if t}
    assert all([n for n, _ in v] == list(range(len(v))) for v in got.values())


GOOD = {
    "semantic_purpose": {"value": "Efficacy Results", "confidence": 0.5, "justification": "j"},
    "persona_relevance_scores": {p: {"score": 0.1, "justification": "j"} for p in quality.PERSONAS},
    "typed_entities": [],
    "quality_assessment": {"confidence": 1, "is_ambiguous": False, "justification": "j"},
}


def test_lines_of_files_in_splits(spark, tmp_path):
    """Files are read in splits, and their lines numbered over them."""
    texts = {"a.txt": [f"line {i} " + "x" * (i % 50) for i in range(3000)], "sub/b.txt": ["", "one", "", "two\r"], "c.txt": []}
    for name, lines in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes("".join(x + "\n" for x in lines).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        got = scan.text_lines(spark, f"{tmp_path}", "*.txt")
        assert got.rdd.getNumPartitions() > 1
        rows = {}
        for r in got.collect():
            rows.setdefault(r.file.rsplit("/", 1)[1], []).append((r.line_no, r.line))
        assert {k: [x for _, x in sorted(v)] for k, v in rows.items()} == {"a.txt": texts["a.txt"], "b.txt": texts["sub/b.txt"]}
        assert all([n for n, _ in sorted(v)] == list(range(len(v))) for v in rows.values())
        heads = scan.head_files(spark, f"{tmp_path}", 700, "*.txt").filter("file = 'a.txt'").orderBy("line_no").collect()
        assert [r.line for r in heads] == texts["a.txt"][:700]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_enrichment_checks_every_answer(spark, tmp_path):
    cases = {
        "good answer of the model": json.dumps(GOOD),
        "fenced answer of the model": f"Here:\n```json\n{json.dumps(GOOD)}\n```",
        "answer with another key in it": json.dumps(GOOD | {"more": 1}),
        "answer without justification": json.dumps(GOOD | {"persona_relevance_scores": {p: {"score": 0.1} for p in quality.PERSONAS}}),
        "answer that is no JSON at all": "sorry",
    }
    seen = spark.sparkContext.accumulator(0)

    def model():
        def answer(prompt):
            seen.add(1)
            assert prompt.startswith("DOCUMENT: T\nSECTION: A -> B\nTEXT: ") or "call fails" in prompt
            if "call fails" in prompt:
                raise RuntimeError("busy")
            return cases[prompt.rsplit("TEXT: ", 1)[1]]

        return answer

    texts = [*cases, "the call fails for this text", "short", None, "% & ( ) = + * ~ ^ % & ( ) = +"]
    df = spark.createDataFrame([(i, t, "semantic_text", "T", ["A", "B"]) for i, t in enumerate(texts)], "chunk_id int, text string, chunk_type string, doc_title string, section_path array<string>")
    got = {r.chunk_id: r for r in enrich.enrich(df, model).collect()}
    assert seen.value == 6  # junk isn't shown to the model
    assert [got[i].chunk_type for i in range(9)] == ["efficacy_results"] * 2 + ["semantic_text"] * 4 + ["miscellaneous"] * 3
    assert [got[i].error for i in range(9)] == [None, None, "invalid payload: unknown key", "invalid payload: persona_relevance_scores", got[4].error, "RuntimeError: busy", None, None, None]
    assert got[4].error.startswith("invalid payload: not JSON") and got[2].semantic_purpose is None and got[6].quality_assessment.is_ambiguous
    good, bad = enrich.quarantine_split(enrich.enrich(df, model), f"file://{tmp_path}/store")
    assert good.count() == 5 and json.loads(bad.filter("chunk_id = 2").first().original_chunk)["text"] == texts[2]


def test_prompts(spark, tmp_path):
    (tmp_path / "greet.txt").write_text("Hello {name}!")
    registry = enrich.load_prompts(str(tmp_path))
    assert spark.range(1).select(enrich.render("greet", registry, name=F.lit("x")).alias("p")).first().p == "Hello x!"
    with pytest.raises(KeyError, match="no prompt named other"):
        enrich.render("other", registry)


def test_multi_vectors_fail_one_by_one(spark):
    def embedder():
        def embed(text):
            if "bad" in text:
                raise ValueError(text)
            return [1.0]

        return embed

    def summarizer():
        def answer(prompt):
            text = prompt.rsplit("\n", 1)[1]
            return json.dumps({"clinical_summary": f"c {text}", "economic_summary": "bad one" if text == "half" else " "}) if text != "none" else "[]"

        return answer

    df = spark.createDataFrame([(t, "d", ["s"], None, t) for t in ("full", "half", "none", "bad base")] + [("null", None, None, "p", None)], "chunk_id string, doc_id string, section_path array<string>, purpose string, text string")
    got = rows_of(vectors.vector_payload(df, embedder, summarizer).select("id"))
    assert got == [("full::base",), ("full::clinical",), ("half::base",), ("half::clinical",), ("none::base",), ("null::base",), ("null::clinical",)]


def test_cosine_topk_equals_direct_search(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    x[7] = x[3] * 2  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 5), (902, [1.0, 2.0]), (903, [float("nan")] * 5), (904, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = set()
    for q in range(0, 300, 10):
        near = sorted((i for i in range(300) if i != q), key=lambda i: (-round(float(u[q] @ u[i]), 6), i))[:4]
        want |= {(q, i, k + 1) for k, i in enumerate(near)}
    for block in (16_384, 37):
        got = vectors.cosine_topk(df.filter("vec_id % 10 = 0"), df, 4, block)
        assert {(r.query_id, r.vec_id, r["rank"]) for r in got.collect()} == want


def test_page_wise_extraction(spark):
    def model():
        def answer(prompt):
            text = prompt.split("\n", 1)[1]
            if text == "fail":
                raise TimeoutError
            return text

        return answer

    page = lambda **k: json.dumps(k)
    pages = [("a", 1, " \n"), ("a", 2, page(title="", sponsor="S", page_sections=[{"heading": "h1", "text": "t1"}, {"heading": "x"}])), ("a", 3, "fail"), ("a", 4, page(title="T", sponsor="Z", page_sections=[{"heading": "h2", "text": "t2"}])), ("b", 1, "no json"), ("c", 1, page(title="C"))]
    docs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "doc_id string")
    got = {r.doc_id: r for r in models.extract_pages(docs, spark.createDataFrame(pages, "doc_id string, page int, text string"), model).collect()}
    assert (got["a"].title, got["a"].sponsor) == ("T", "S") and [tuple(s) for s in got["a"].sections] == [("h1", "t1", 1), ("h2", "t2", 2)]
    assert got["b"].error == got["d"].error == models.NOTHING_READ and got["c"].sections == [] and got["c"].error is None


def test_triage_by_pages_only(spark):
    pages = spark.createDataFrame([("a", 1, "x"), ("b", 1, " "), ("b", 9, "long"), ("c", 1, None)], "doc_id string, page int, text string")
    got = {r.doc_id: tuple(r)[1:] for r in models.triage(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "doc_id string"), pages).collect()}
    assert got == {"a": (1.0, "vector_analysis", 1.0), "b": (0.0, "vector_analysis", 1.0), "c": (0.0, "vector_analysis", 1.0), "d": (None, "empty_document", 0.0)}


def test_tables_and_kinds_of_blocks(spark):
    heads = spark.createDataFrame([(1, 0, "Methods", 1, 1, 0.0, 1.0)], "doc_id int, ord int, text string, level int, page int, y0 double, y1 double")
    blocks = spark.createDataFrame([(1, 0, 1, 0.0, "Methods", "text"), (1, 1, 1, 5.0, "Some text.", "text"), (1, 2, 1, 6.0, "a|b", "table"), (2, 0, 1, 0.0, "No heading.", "text")], "doc_id int, ord int, page int, y0 double, text string, block_type string")
    tables = spark.createDataFrame([(1, "p1-t0", 1, "A table.", " |a| \n"), (1, "p1-t1", 1, "Blank.", " "), (1, "p1-t2", 1, None, "|x|"), (1, "p1-t3", 1, "", "|x|")], "doc_id int, table_id string, page int, llm_summary string, markdown string")
    c = chunk_documents(heads, blocks, tables=tables)
    got = sorted((r.doc_id, r.chunk_type, r.section_path, r.text, r.raw_table_content) for r in c.collect())
    assert got == [
        (1, "semantic_text", ["Methods"], "Some text.", None),
        (1, "table_summary", ["Tables", "Page 1"], "A table.", "|a|"),
        (1, "table_summary", ["Tables", "Page 1"], "Blank.", None),
        (2, "semantic_text", ["Unstructured Document"], "No heading.", None),
    ]
    full = quality.content_completeness(blocks.filter("ord > 0 or doc_id = 2"), tables.filter("table_id = 'p1-t0'"), c)
    assert {r.doc_id: (r.source_chars, r.chunk_chars) for r in full.collect()} == {1: (16, 13), 2: (11, 11)}
    assert table_chunks(tables.limit(0)).count() == 0


def test_orphans_by_box(spark):
    heads = spark.createDataFrame([(1, 1, 10.0, 5.0)], "doc_id int, page int, x0 double, y0 double")
    blocks = spark.createDataFrame([(1, 0, 1, 10.0, 5.0), (1, 1, 1, 60.0, 5.0)], "doc_id int, ord int, page int, x0 double, y0 double")
    none = spark.createDataFrame([], "doc_id int, ord int")
    assert [r.ord for r in structure.orphan_blocks(blocks, heads, none).collect()] == [1]


def test_edges_need_their_ends(spark):
    nodes = spark.createDataFrame([("d", "Document"), ("d_page_1", "Page"), ("e", "Entity")], "id string, label string")
    edges = spark.createDataFrame([("d", "d_page_1", "HAS_PAGE"), ("x", "d_page_1", "HAS_PAGE"), ("d_page_1", "e", "MENTIONS"), ("d_page_1", "gone", "MENTIONS"), ("e", "d_page_1", "MENTIONS")], "src string, dst string, type string")
    assert rows_of(graph.checked_edges(edges, nodes)) == [("d", "d_page_1", "HAS_PAGE"), ("d_page_1", "e", "MENTIONS")]


def test_labels(spark):
    pairs = spark.createDataFrame([("f", "b", "a"), ("g", "a", "c")], "file string, truth string, guess string")
    assert [r.label for r in evaluate.labels(pairs).collect()] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="labels"):
        evaluate.confusion(pairs, most=2)


def test_strings_and_dates(spark):
    df = spark.createDataFrame([(" a ", [" b", None], {" k ": " v "}, (None, [(" z ",)]), 1)], "a string, b array<string>, m map<string,string>, s struct<x:string,y:array<struct<q:string>>>, n int")
    r = T.trim_table(df).first()
    assert (r.a, r.b, r.m, r.s.x, r.s.y[0].q, r.n) == ("a", ["b", None], {" k ": "v"}, None, "z", 1)
    days = ["2024-02-29", "2024-02-29T01:02:03.5", "2023-02-29", "29/02/2024", "", None]
    got = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d string").select("i", F.date_format(dates.iso_or_default(F.col("d")), "yyyy-MM-dd HH:mm").alias("t")).orderBy("i").collect()
    assert [x.t for x in got] == ["2024-02-29 00:00", "2024-02-29 01:02"] + ["1970-01-01 00:00"] * 4


def test_log_has_one_handler_of_each_kind(tmp_path):
    log = config.logger("lamina.test", str(tmp_path / "a.log"))
    assert config.logger("lamina.test", str(tmp_path / "a.log")) is log and len(log.handlers) == 2
    log.info("hello")
    assert "[INFO] hello" in (tmp_path / "a.log").read_text()


def test_personas_are_bounded(spark):
    one = lambda names: spark.createDataFrame([(({n: (0.1, "j") for n in names},),)], "metadata struct<persona_relevance_scores:map<string,struct<score:double,justification:string>>>")
    assert vectors.persona_names(one(["b", "a"])) == ["a", "b"]
    with pytest.raises(ValueError, match="over 2 personas"):
        vectors.persona_names(one(["a", "b", "c"]), 2)

"""The jobs: two runs over growing input, equal reruns, and their queries against SQL."""

import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import common, ingest_chunks, publish_records, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def chunks(spark, out):
    return sorted(map(tuple, ingest_chunks.current(spark, out).select("doc_id", "nth", "chunk_id", "text", "low_value", "lang").collect()), key=str)


def test_growing_input(spark, docs, tmp_path):
    """The second run takes only what is new; documents delivered again add nothing; a changed text replaces the old one."""
    src, out, ck = (f"file://{tmp_path}/{x}" for x in ("in", "out", "ck"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    docs.filter("doc_id < 100").write.parquet(f"{src}/a")
    src_glob = f"{src}/*"
    ingest_chunks.run(spark, src_glob, out, ck)
    first = chunks(spark, out)
    n_files = {p.name for p in Path(tmp_path, "out").rglob("part-*")}
    assert first and {r[0] for r in first} <= set(range(100))
    # again, without new files: nothing is written
    ingest_chunks.run(spark, src_glob, out, ck)
    assert {p.name for p in Path(tmp_path, "out").rglob("part-*")} == n_files
    # old documents again, new ones, one with another text, one that became empty
    more = docs.filter("doc_id >= 50").withColumn("text", F.when(F.col("doc_id") == 60, "Another text. It is short.").when(F.col("doc_id") == 61, "").otherwise(F.col("text")))
    more.write.parquet(f"{src}/b")
    ingest_chunks.run(spark, src_glob, out, ck)
    rows = spark.read.parquet(out)
    assert {r.doc_id for r in rows.filter("batch > 0").select("doc_id").distinct().collect()} == {60, 61, *(r.doc_id for r in docs.filter("doc_id >= 100").collect())}
    got = chunks(spark, out)
    assert [r[3] for r in got if r[0] == 60] == ["Another text. It is short."] and not [r for r in got if r[0] == 61]
    # the same as one run over the final state
    last = docs.filter("doc_id < 50").unionByName(more)
    last.write.parquet(f"file://{tmp_path}/whole/x")
    ingest_chunks.run(spark, f"file://{tmp_path}/whole/*", f"file://{tmp_path}/out2", f"file://{tmp_path}/ck2")
    assert got == chunks(spark, f"file://{tmp_path}/out2")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_repeated_batch(spark, docs, tmp_path):
    """A batch that is done again, as after a crash before its commit was noted, leaves the same rows."""
    src, out, ck = (f"file://{tmp_path}/{x}" for x in ("in", "out", "ck"))
    docs.limit(40).write.parquet(f"{src}/a")
    ingest_chunks.run(spark, f"{src}/*", out, ck)
    first = chunks(spark, out)
    for p in Path(tmp_path, "ck", "commits").iterdir():
        p.unlink()
    ingest_chunks.run(spark, f"{src}/*", out, ck)
    assert chunks(spark, out) == first
    assert spark.read.parquet(out).select("batch").distinct().count() == 1


def test_edges(spark, tmp_path):
    rows = [(1, None, "en", 5), (2, "", None, 5), (None, "A text without an id.", "de", 5), (None, "A text without an id.", "de", 5), (3, "x" * 300_000, "en", 5), (4, " \n ", "en", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, batch int").write.parquet(f"file://{tmp_path}/in/a")
    ingest_chunks.run(spark, f"file://{tmp_path}/in/*", f"file://{tmp_path}/out", f"file://{tmp_path}/ck")
    got = chunks(spark, f"file://{tmp_path}/out")
    assert sorted((str(r[0]), len(r[3]), r[5]) for r in got) == [("3", 300_000, "en"), ("None", 21, "de")]


def test_publish_again(spark, docs, tmp_path):
    """A rerun over other input leaves nothing of the first; large documents are several records, empty ones in quarantine."""
    src, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    extra = spark.createDataFrame([(9001, None, "xx", "src-11-2022-x"), (9002, " ".join(f"Sentence number {i} is here." for i in range(9000)), "xx", "src")], "doc_id long, text string, lang string, source string")
    docs.select("doc_id", "text", "lang", "source").unionByName(extra).write.parquet(f"{src}/a")
    publish_records.run(spark, f"{src}/a", out)
    big = sorted((r.part, r.n_parts, len(r.chunks)) for r in publish_records.written_records(spark, out).filter("doc_id = 9002").collect())
    assert [b[0] for b in big] == list(range(big[0][1])) and big[0][1] > 1 and all(b[2] == 200 for b in big[:-1])
    apart = publish_records.written_records(spark, out).filter("status <> 'published'").collect()
    assert [(r.doc_id, r.status, r.lang, r.chunks, r.document_level_metadata.publication_date) for r in apart] == [(9001, "no text", "xx", [], "2022-11-01T00:00:00")]
    summary = {(r.lang, r.status): int(r.documents) for r in spark.read.option("header", "true").csv(f"{out}/summary").collect()}
    assert summary["xx", "no text"] == 1 and sum(summary.values()) == docs.count() + 2
    docs.filter("doc_id < 10").select("doc_id", "text", "lang", "source").write.parquet(f"{src}/b")
    publish_records.run(spark, f"{src}/b", out)
    assert {(r.doc_id, r.status) for r in publish_records.written_records(spark, out).select("doc_id", "status").distinct().collect()} == {(i, "published") for i in range(10)}


def test_settings(tmp_path):
    own = tmp_path / "own.toml"
    own.write_text("chunk_size = 300\n")
    assert common.settings(ingest_chunks.__file__, str(own)) == common.settings(ingest_chunks.__file__) | {"chunk_size": 300}


def test_text_stays_in_place(spark, docs):
    """No exchange between the scan and the records."""
    cfg = common.settings(publish_records.__file__)
    plan = publish_records.records(publish_records.judged(docs, cfg), cfg)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def plain(v):
    return (None if math.isnan(v) else round(v, 4)) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_rows(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str) == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=str)

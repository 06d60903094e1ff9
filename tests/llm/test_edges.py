"""Very long texts, nulls and clashing names through every operator on documents."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from lamina.llm import embedding_dedup, katz, line_dedup, mixing, packing, quality, sharding, simhash, substring_dedup
from lamina.llm.queries import tokenizer_file

rng = np.random.default_rng(1)
LONG = "\n".join(" ".join(f"{'abcdefgh'[int(k) % 8]}{k}" for k in rng.integers(0, 5000, 40)) for _ in range(5000))  # over a megabyte
ROWS = [(1, LONG, "en", "a"), (2, LONG[: len(LONG) // 2], "en", "a"), (3, None, None, None), (4, "", "en", "b"), (5, "x" * 1_000_000, "en", "b"), (6, "one two three four five six", "fr", "c"), (6, "one two three four five six", "fr", "c")]
#: Names that operators use inside.
CLASH = ["key", "k2", "off", "n", "h", "cell", "bucket", "fp", "sid", "block", "words", "size", "piece", "rank", "seg", "grp", "mu", "prec", "spans", "held", "slot"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t, a, s, len(t or "")) for i, t, a, s in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(7).alias(c) for c in CLASH]).repartition(3)


def test_lines(docs):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, ["doc_id", "h"]).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed >= got[2].n_lines - 3 and got[3].text is None and got[5].n_removed == 0 and got[1].h == 7


def test_katz(docs):
    got = {r.doc_id: r for r in katz.score(docs, F.col("doc_id") == 2).collect()}
    assert got[1].n_tokens == 200_001 and got[2].held_out and got[3].n_tokens == 1 and got[5].n_tokens == 2 and got[2].score > got[2].base_score


def test_shards(docs):
    got = {r.doc_id: r for r in sharding.shard(docs, 3, 8).collect()}
    assert got[1].size == len(LONG) + 8 and got[3].size == 8 and got[5].text_crc32 == zlib.crc32(b"x" * 1_000_000)


def test_statistics():
    words = LONG.split()
    got = quality.text_stats(LONG)
    assert got[0] == len(words) == 200_000 and got[5] == 5000 and quality.text_stats(None) == quality.text_stats("") == (0,) * 7


def test_near_duplicates(docs):
    got = [(r.doc_id, r.component_id, r.n) for r in simhash.near_duplicates(docs, ["doc_id", "n"]).collect()]
    assert len(got) == 7 and {(3, 3, 7), (4, 3, 7)} <= set(got) and (6, 6, 7) in got


def test_substrings(docs):
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(docs, ["doc_id", "key"]).collect()}
    assert got[2].n_removed == got[2].n_bytes and got[1].n_removed == got[2].n_bytes and got[1].n_spans == 1
    assert got[5].n_removed == 1_000_000 and got[3].n_bytes == 0 and got[6].n_removed == 0 and got[1].key == 7


def test_packing(docs):
    got = packing.pack(docs, tokenizer_file(), ["doc_id", "seg"]).collect()
    ends = {}
    for r in got:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in ends.values():
        x.sort()
        assert all(o == sum(n for _, n in x[:k]) for k, (o, _) in enumerate(x)) and sum(n for _, n in x) <= 1024
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, 6} and sum(r.doc_id == 6 for r in got) == 2


def test_mixing(docs):
    got = {r.doc_id: r for r in mixing.mix(docs, ["doc_id", "cell"]).collect()}
    assert got[1]["size"] == 200_000 and got[3].taken == 0 and got[6].cell == 7


def test_pipeline_with_other_columns(spark, docs):
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == P.COLUMNS, name
    assert P.pack_sequences(spark, docs, "").filter("doc_id = 1").agg(F.sum("length")).first()[0] > 200_000


def test_vectors_of_every_length(spark):
    x = rng.normal(size=(60, 3))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(100, 4)))] + [(200 + i, v.tolist(), i % 2) for i, v in enumerate(np.concatenate([x, x * 3 + 1e-3]))] + [(900, [2.0], 0), (901, [5.0], 0), (902, [-1.0], 0), (903, [], 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, dims int").repartition(3)
    for block in (4096, 7):
        link = embedding_dedup.link_exactly
        link.__defaults__ = (block,)
        got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, 0.93).collect()}
        unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows if 200 <= i < 900}
        label = {i: lab for i, _, lab in rows}
        for i, u in unit.items():
            near = [j for j, w in unit.items() if j != i and label[i] == label[j] and u @ w >= 0.93]
            assert got[i].n_links == len(near) and got[i].component_id <= min([i, *near])
        assert (got[900].n_links, got[901].component_id, got[902].n_links, got[903].n_links) == (1, 900, 0, 0)
    link.__defaults__ = (embedding_dedup.BLOCK,)


def test_links_close_to_the_threshold(spark):
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    near, below = (c * x + np.sqrt(1 - c * c) * away for c in (0.932, 0.925))
    rows = [(i, v.tolist(), i % 3) for part, first in ((x, 0), (near, 10_000), (below[:300], 20_000)) for i, v in enumerate(part, first)]
    rows = [(i, v, i % 10_000 % 3) for i, v, _ in rows]
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    found = sum(got[10_000 + i].component_id == got[i].component_id for i in range(1500))
    assert found >= 0.97 * 1500  # of links at the hardest distance; the required recall is 0.9
    v = {i: np.array(e) for i, e, _ in rows}
    linked = [i for i in range(300) if got[20_000 + i].n_links]
    assert all(any(v[20_000 + i] @ (w / np.linalg.norm(w)) >= 0.93 for j, w in v.items() if j != 20_000 + i) for i in linked)

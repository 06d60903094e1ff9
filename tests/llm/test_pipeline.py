"""The pipeline's stages, each on what the one before kept."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_operators import WORD, sample
from tests.llm.test_short_runs import brute_runs
from tests.llm.test_similar_texts import brute_groups


def test_stages(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    prose = [(i, "\n".join(" ".join(f"{rng.choice(list('abcdefgh'))}{rng.integers(0, 400)}" for _ in range(25)) for _ in range(4)), "en", "s") for i in range(400)]
    rows = prose + [(500, prose[7][1], "en", "s"), (501, prose[8][1] + "\nmore words here", "en", "t"), (502, "short", "en", "t"), (503, " ".join("###%%" for _ in range(50)), "en", "s")] + [(i and 600 + i, t, lang, s) for i, t, lang, s in sample()[-7:]]
    # near copies with one word changed in the second and the fourth line (Jaccard 86/106), and a passage of two lines of 25 words among own lines
    near = lambda n, at: "\n".join(" ".join(f"zz{n}" if j % 2 and k == 8 + at % 9 else w for k, w in enumerate(x.split())) for j, x in enumerate(prose[n][1].split("\n")))
    own = lambda seed: " ".join(f"own{seed}x{k % 60}" for k in range(40))
    rows += [(510 + n, near(n, n), "en", "s") for n in range(20, 26)]
    rows += [(540, own(1) + "\n" + "\n".join(prose[30][1].split("\n")[1:3]) + "\n" + own(2), "en", "s")]
    docs = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = P.quality_rules(spark, docs, "").cache()
    assert kept.columns == P.COLUMNS
    ids = {r.doc_id for r in kept.collect()}
    sure = set(range(400)) | {500, 501, 540, *range(530, 536)}
    assert sure <= ids <= sure | {603, 1603}  # the last two are prose of the sample
    cut = P.dedup_lines(spark, kept, "").cache()
    want = {k: v for k, v in brute_runs([tuple(r)[:2] for r in kept.collect()], 3, 50).items() if WORD.search(v)}
    assert all(x not in want[540, dict((r.doc_id, r.text) for r in kept.collect())[540]] for x in prose[30][1].split("\n")[1:3])
    assert {(r.doc_id, r.text) for r in cut.collect()} == {(i, v) for (i, _), v in want.items()}
    assert cut.filter(F.col("n_chars") != F.length("text")).count() == 0
    one = P.simhash_near_dedup(spark, cut, "").cache()
    rs = sorted(cut.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    first = {rs[g].doc_id for g in brute_groups([r.text for r in rs])}
    assert sorted(r.doc_id for r in one.collect()) == sorted(first) and not first & set(range(530, 536))
    mixed = P.mix_sources(spark, one, "").cache()
    sizes = Counter()
    for r in one.collect():
        sizes[r.source] += len(WORD.findall(r.text))
    got = Counter()
    for r in mixed.collect():
        got[r.source] += len(WORD.findall(r.text))
    assert abs(sum(got.values()) - sum(sizes.values())) <= len(sizes)
    packed = P.pack_sequences(spark, mixed, "")
    ends = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert ends.filter("n > 1024 or n <> end").count() == 0
    assert packed.filter("piece = 0").count() == mixed.count()


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_order():
    assert [re.sub("_.*", "", n) for n, _ in P.STAGES] == ["quality", "line", "simhash", "mixing", "packing"]

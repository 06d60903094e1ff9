"""The pipeline's near-dedup links by fingerprints too: near copies by SimHash whose sets are less similar."""

import corpus_pipeline as P
from lamina.llm import simhash


def test_fingerprints_link(spark):
    often = " ".join(f"w{k}" for k in range(7)) + " "
    text = lambda own, n: often * 300 + " ".join(f"{own}{k}" for k in range(n))
    a, b = text("a", 12), text("b", 12)
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in (a, b)]
    assert len(sets[0] & sets[1]) < 0.8 * len(sets[0] | sets[1])
    prints = [simhash.majority(simhash.shingle_hashes(t, 5)) for t in (a, b)]
    assert (prints[0] ^ prints[1]).bit_count() <= 4
    other = " ".join(f"o{k}" for k in range(400))
    near = other.replace("o100 ", "x100 ").replace("o300 ", "x300 ")
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([a, b, other, near, " ".join(f"p{k}" for k in range(90))])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in P.simhash_near_dedup(spark, docs, "").collect()) == [0, 2, 4]

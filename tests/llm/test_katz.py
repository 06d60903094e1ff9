"""The block-and-bucket model against a direct one, and its normalisation."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import katz

WORDS = "a b c d e f g h i j k l m n o p q r s t".split()


def brute(docs, held):
    seqs = [(i, ["<e>", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))), "<e>"]) for i, t in docs]
    train = [s for (i, s), h in zip(seqs, held, strict=True) if not h]
    uni = Counter(w for s in train for w in s[1:])
    bi = Counter(x for s in train for x in zip(s, s[1:], strict=False))
    nr = lambda c: [0] + [sum(v == r for v in c.values()) for r in range(1, katz.K + 2)]
    d1, d2 = katz.discounts(nr(uni)), katz.discounts(nr(bi))
    total = sum(uni.values())
    d = lambda d, r: d[r] if r <= katz.K else 1.0
    kept = sum(d(d1, r) * r for r in uni.values())
    over = total if kept < total else total + 1
    unknown = 1 - kept / over if total else 1.0
    p1 = lambda w: d(d1, uni[w]) * uni[w] / over if w in uni else unknown

    def ctx(v):
        succ = {w: r for (a, w), r in bi.items() if a == v}
        c = sum(succ.values())
        if not c:
            return {}, 1.0
        kept = sum(d(d2, r) * r for r in succ.values())
        over = c if kept < c else c + 1
        return {w: d(d2, r) * r / over for w, r in succ.items()}, (1 - kept / over) / (1 - sum(p1(w) for w in succ))

    cache = {}

    def p(v, w):
        if v not in cache:
            cache[v] = ctx(v)
        seen, weight = cache[v]
        return seen[w] if w in seen else weight * p1(w)

    score = {i: sum(math.log10(p(v, w)) for v, w in zip(s, s[1:], strict=False)) for i, s in seqs}
    base = {i: sum(math.log10((uni[w] + 1) / (total + len(uni) + 1)) for w in s[1:]) for i, s in seqs}
    return score, base, p, uni, total


def make(n, seed, low=0):
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, 21) ** 1.3
    return [(i, " ".join(rng.choice(WORDS, rng.integers(low, 60), p=p / p.sum()))) for i in range(n)]


@pytest.mark.parametrize("block,share", [(10**9, None), (300, 40)])
def test_equals_direct_model_and_is_normalised(spark, monkeypatch, block, share):
    docs = make(80, 1) + [(100, None), (101, ""), (102, "zzz A yyy zzz"), (103, "A\tb  c\n\nzzz\xa0d")]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 or i >= 102 for i, _ in docs]
    monkeypatch.setattr(katz, "BLOCK", block)
    monkeypatch.setattr(katz.blocks, "__defaults__", (block,))
    if share:
        monkeypatch.setattr(katz, "BI_BUCKET", 4 * share)  # frequent contexts are split
    df = spark.createDataFrame([(i, t, h) for (i, t), h in zip(docs, held, strict=True)], "doc_id long, text string, h boolean").repartition(3)
    got = {r.doc_id: r for r in katz.score(df, F.col("h")).collect()}
    score, base, p, uni, total = brute(docs, held)
    assert len(got) == len(docs)
    for i, _ in docs:
        assert got[i].score == pytest.approx(score[i], abs=1e-9)
        assert got[i].base_score == pytest.approx(base[i], abs=1e-9)
        assert got[i].train_tokens == total
    for v in ["<e>", "a", "t", "never"]:
        assert sum(p(v, w) for w in [*uni, "never"]) == pytest.approx(1, abs=1e-12)
    assert got[100].n_tokens == 1 and got[102].n_known == 2


def test_better_than_base_on_held_out(spark):
    docs = [(i, " ".join(x for w in t.split() for x in (w, w + w))) for i, t in make(200, 3, 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    r = katz.score(df, F.col("doc_id") % 7 == 2).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_empty_and_nothing_to_learn(spark):
    df = spark.createDataFrame([], "doc_id long, text string, score string")
    assert katz.score(df, F.lit(False)).count() == 0
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    rows = katz.score(df, F.lit(True)).collect()
    assert len(rows) == 3 and all(r.score == 0 and r.train_tokens == 0 for r in rows)


def test_discounts_fall_back():
    for n in ([0] * 7, [0, 5, 0, 0, 0, 0, 0], [0, 10, 50, 3, 2, 1, 1], [0, 100, 40, 20, 12, 8, 6]):
        d = katz.discounts(n)
        assert (d[1:] > 0).all() and (d[1:] < 1).all()


def test_own_probabilities_are_normalised(spark):
    docs = make(60, 5) + [(70 + i, "a " + " ".join(WORDS) + " a") for i in range(3)] + [(80, " ".join(f"a {w}" for w in WORDS))]  # all words follow a
    seen = sorted({w for _, t in docs for w in t.split()})
    asked = [(1000 + k, f"{v} {w}".strip()) for k, (v, w) in enumerate((v, w) for v in ("a", "t", "zzz") for w in [*seen, "zzz", ""])]
    df = spark.createDataFrame([(i, t, i >= 1000) for i, t in docs + asked], "doc_id long, text string, h boolean")
    got = {r.doc_id: r.token_scores for r in katz.score(df, F.col("h"), with_tokens=True).collect()}
    n = len(seen) + 2
    for c in range(3):  # the second token of each: every known word, an unknown one, the end
        assert sum(10 ** got[1000 + c * n + k][1] for k in range(n)) == pytest.approx(1, abs=1e-12)
    assert sum(10 ** got[1000 + k][0] for k in (0,)) < 1


def test_counts_above_32_bits(spark):
    words = np.array([5, 6, 7], np.uint64)
    rows = [(b, katz.pack(words, np.array([4_000_000_000, 1, 0], "<u4")), 3) for b in range(3)]
    out = katz.unigrams(spark.createDataFrame(rows, "block long, vocab binary, entries long")).collect()
    counts = {}
    for r in out:
        if r.kind == "r":
            count, _ = map(katz.unplanes, katz.unpack(bytes(r.data), "u1", "u1"))
            counts.update(zip((words[words % np.uint64(48) == r.bucket]).tolist(), count.tolist(), strict=True))
    assert counts == {5: 12_000_000_000, 6: 3, 7: 0}
    assert sum(r.stats[0] for r in out if r.kind == "n") == 12_000_000_003

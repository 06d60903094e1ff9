"""Learned sentence boundaries: statistics against direct counts, and a corpus whose abbreviations are known."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lamina.operators import boundaries as B


@pytest.fixture(scope="module")
def corpus():
    """Sentences of a small language; approx., cf. and Dr. never end one, words do."""
    r = random.Random(4)
    words = ["tree", "house", "water", "stone", "light", "river", "night", "paper", "green", "small", "runs", "stands", "falls", "opens"]
    def sentence():
        w = [r.choice(words) for _ in range(r.randint(4, 9))]
        for mark in ("approx.", "cf."):
            if r.random() < 0.3:
                w.insert(r.randrange(1, len(w)), mark)
        if r.random() < 0.3:
            at = r.randrange(1, len(w))
            w[at:at] = ["Dr.", r.choice(["Weber", "Moreau", "Okafor"])]
        first = r.choice(["The", "But", "However"]) + " " + w[0] if not w[0].endswith(".") else "The " + w[0]
        return " ".join([first, *w[1:]]) + r.choice([".", ".", ".", "?", "!"])

    return [[sentence() for _ in range(r.randint(1, 12))] for _ in range(300)]


@pytest.fixture(scope="module")
def texts(spark, corpus):
    return spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(corpus)] + [(-1, None), (-2, " \n")], "doc_id long, text string")


@pytest.fixture(scope="module")
def model(texts):
    return B.learn(texts)


def test_counts(texts, corpus):
    got = {r.type: (r.with_dot, r.without) for r in B.counts(B.tokens(texts)).collect()}
    want = Counter(w for s in corpus for x in s for w in x.split())
    assert got["approx"] == (want["approx."], 0)
    assert got["tree"] == (want["tree."], want["tree"] + want["tree?"] + want["tree!"]) or got["tree"][0] == want["tree."]


def test_association(spark):
    def direct(a, b, ab, n):
        def ll(k, m, p):
            return (k * math.log(p) if k else 0) + ((m - k) * math.log(1 - p) if m > k else 0)

        p, p1, p2 = b / n, ab / a, (b - ab) / (n - a)
        return -2 * (ll(ab, a, p) + ll(b - ab, n - a, p) - (0 if a == ab else ll(ab, a, p1)) - (0 if p2 <= 0 or p2 >= 1 else ll(b - ab, n - a, p2)))

    rows = [(10, 20, 5, 1000), (10, 10, 10, 1000), (7, 300, 1, 900), (50, 5, 5, 10_000)]
    df = spark.createDataFrame(rows, "a long, b long, ab long, n long")
    got = [r.x for r in df.select(B.association(*map(F.col, ("a", "b", "ab", "n"))).alias("x")).collect()]
    assert got == pytest.approx([direct(*r) for r in rows])


def test_learned(model):
    assert {"approx", "cf", "dr"} <= model.short and not {"tree", "water", "weber"} & model.short
    assert {"however", "but"} <= model.starters
    assert ("dr", "weber") in model.together


def test_all_boundaries(spark, texts, corpus, model):
    got = {r.doc_id: r.sentences for r in B.sentences_trained(texts, model).collect()}
    assert got[-1] == [] and got[-2] == []
    right = sum(got[i] == s for i, s in enumerate(corpus))
    assert right >= 0.98 * len(corpus)
    # the rule alone, that a capital after a period begins a sentence, gets far fewer
    plain = B.Boundaries()
    assert sum(plain.split(" ".join(s)) == s for s in corpus) < 0.7 * len(corpus)


def test_nothing_is_lost(model):
    for text in ("", "no end", "One. Two! Three? (Four.) \"Five.\" six...", "A. B. C.", "x" * 100_000 + ". Y", ". . .", "!\n?\n"):
        assert "".join("".join(model.split(text)).split()) == "".join(text.split())


def test_after_an_abbreviation(model):
    assert model.split("It is cf. However it stands.") == ["It is cf.", "However it stands."]  # a starter
    assert model.split("We saw Dr. Weber. But the night falls.") == ["We saw Dr. Weber.", "But the night falls."]
    assert model.split("He said so (really.) then left. Next") == ["He said so (really.) then left.", "Next"]


def test_empty_corpus(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert B.learn(none) == B.Boundaries() and B.sentences_trained(none, B.Boundaries()).collect() == []

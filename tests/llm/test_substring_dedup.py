"""Repeated strings against a direct count."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from lamina.llm import substring_dedup as S


def brute(docs, length):
    datas = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i : i + length] for d in datas for i in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(docs, datas, strict=True):
        flag = bytearray(len(d))
        for a in range(len(d) - length + 1):
            if seen[d[a : a + length]] > 1:
                flag[a : a + length] = b"\1" * length
        left = bytes(c for c, f in zip(d, flag, strict=True) if not f)
        out.append((i, len(d), sum(flag), sum(1 for k in range(len(d)) if flag[k] and not (k and flag[k - 1])), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    text = lambda k: "".join(rng.choice(list("abcé \n"), k))
    shared = [text(int(k)) for k in rng.integers(20, 300, 6)]
    docs = []
    for i in range(n):
        parts = [text(int(rng.integers(0, 60)))]
        for _ in range(int(rng.integers(0, 4))):
            s = shared[int(rng.integers(0, 6))]
            a = int(rng.integers(0, len(s)))
            parts += [s[a:] if rng.random() < 0.5 else s, text(int(rng.integers(0, 30)))]
        docs.append((i, "".join(parts)))
    near = text(400)
    for i in range(20):  # near copies
        at = int(rng.integers(0, 400))
        docs.append((n + i, near[:at] + "#" + near[at + 1 :]))
    return docs


@pytest.mark.parametrize("wide", [10_000, 8, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_direct_count(spark, seed, wide):
    docs = [*corpus(seed), (900, None), (901, ""), (902, "a" * 300), (903, "xyz" * 90), (904, "q" * 25), (904, "q" * 25), (None, "w" * 41)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, key int").repartition(5)
    got = S.dedup_substrings(df, length=40, gram=12, wide=wide).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(docs, 40)


def test_planted_passages(spark):
    """Passages of over 50 words in two documents each: those of 400 bytes go wholly from both, shorter ones stay, and so do clean documents."""
    rng = np.random.default_rng(7)
    words = lambda n, size: " ".join("".join(rng.choice(list("abcdefghij"), size)) for _ in range(n))
    docs, want = [], {}
    for i in range(40):
        planted = words(51 + i, 8) if i % 2 else words(51 + i // 4, 5)  # 467 bytes or more, 359 or fewer
        for j, mark in ((3 * i, "x"), (3 * i + 1, "y")):
            docs.append((j, f"{words(40 + i, 6)} {mark} {planted} {mark} {words(30, 6)}"))
            want[j] = len(planted) + 2 if i % 2 else 0  # with a space on either side
        docs.append((3 * i + 2, words(150, 6)))
        want[3 * i + 2] = 0
    got = S.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: r["n_removed"] for r in got.collect()} == want


def test_empty(spark):
    assert S.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_anchor_ranges_cover_all_starts():
    rng = np.random.default_rng(5)
    for n in (10, 40, 41, 300, 1000):
        data = bytes(rng.integers(97, 99, n).astype(np.uint8))
        h, p, lo, hi = S.anchors(data, 40, 12)
        starts = [s for a, b in zip(lo, hi, strict=True) for s in range(a, b + 1)]
        assert starts == list(range(max(0, n - 39)))
        assert all(a <= q <= a + 28 and b <= q <= b + 28 for q, a, b in zip(p, lo, hi, strict=True))


def test_anchors_are_few_and_follow_the_text():
    rng = np.random.default_rng(6)
    data = bytes(rng.integers(97, 120, 20_000).astype(np.uint8))
    h, p, _, _ = S.anchors(data, 400, 120)
    assert len(h) < 3 * len(data) / (400 - 120 + 2) and len(set(h.tolist())) == len(h)
    h2, p2, _, _ = S.anchors(b"xyz" + data[5000:], 400, 120)
    assert set(h2[p2 > 400].tolist()) <= set(h.tolist())


def test_whole_table_at_full_length(spark):
    """The query on 1000 documents against a direct count of all strings of 400 bytes."""
    import pyarrow.parquet as pq
    import xxhash

    from lamina.llm.queries import queries

    sf = "/root/testdata/sf0.01"
    t = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"])
    docs = [(i, (x or "").encode()) for i, x in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True)]
    each = [np.fromiter((xxhash.xxh3_64_intdigest(d[a : a + 400]) for a in range(len(d) - 399)), np.uint64, max(0, len(d) - 399)) for _, d in docs]
    values, counts = np.unique(np.concatenate(each), return_counts=True)
    again = values[counts > 1]
    want = []
    for (i, d), h in zip(docs, each, strict=True):
        flag = np.zeros(len(d) + 1, np.int64)
        at = np.flatnonzero(np.isin(h, again))
        np.add.at(flag, at, 1)
        np.add.at(flag, at + 400, -1)
        gone = np.cumsum(flag)[: len(d)] > 0
        left = np.frombuffer(d, np.uint8)[~gone].tobytes()
        want.append((i, len(d), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum()), hashlib.sha256(left).hexdigest()))
    assert sum(w[2] for w in want) > 0
    assert sorted(map(tuple, queries()["op7_substring_dedup"](spark, sf).collect())) == sorted(want)

"""Near-dedup of the pipeline: texts with 5-word shingles of Jaccard similarity >= 0.8, by brute force."""

import numpy as np

import corpus_pipeline as P
from lamina.llm import simhash
from tests.llm.test_operators import WORD


def shingles(t):
    words = WORD.findall((t or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(sets))]


def texts():
    rng = np.random.default_rng(1)
    out = []
    for i in range(60):  # copies with 1 to 6 changed words, around the threshold, of texts of 5 to 250 words; chains too
        words = [f"w{x}" for x in rng.integers(0, 3000, [5, 12, 40, 120, 250][i % 5])]
        out.append(" ".join(words))
        for _ in range(i % 4):
            for at in rng.integers(0, len(words), rng.integers(1, max(2, len(words) // 30))):
                words[at] = f"z{rng.integers(0, 10**6)}"
            out.append(" ".join(words))
    head = " ".join(f"h{x}" for x in range(60))
    out += [head + " " + " ".join(f"k{i}_{x}" for x in range(40)) for i in range(30)]  # a shared passage, not similar
    return [*out, out[0].upper(), "", None, " \n", "a b", "A  b", "a b c"]


def test_stage_keeps_one_of_each_group(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    want = set(brute_groups([t for _, t in rows]))
    far = [(a, b) for a in range(len(rows)) for b in range(a) if 5 * len(shingles(rows[a][1]) & shingles(rows[b][1])) >= 4 * len(shingles(rows[a][1]) | shingles(rows[b][1])) and (simhash.fingerprint(rows[a][1]) ^ simhash.fingerprint(rows[b][1])).bit_count() > 4]
    assert far  # pairs that 4 bits of 4-word shingles don't link
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in [*rows, rows[1]]], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert sorted(r.doc_id for r in P.simhash_near_dedup(spark, docs, "").collect()) == sorted(want)


def test_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a b c d e f", "en", "s", 11), (7, "A b c d e f", "en", "s", 11), (None, "x y z", "en", "s", 5), (None, "x  y z", "en", "s", 6)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id or 0, r.text[0]) for r in P.simhash_near_dedup(spark, docs, "").collect()) == [(0, "x"), (7, "A")]


def test_small_blocks_and_order_of_rows(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SIDE", 4)  # many blocks a cell
    rng = np.random.default_rng(3)
    base = [f"b{x}" for x in range(60)]
    rows = []
    for i in range(60):  # near copies of one text, half of them not similar to one another
        words = list(base)
        for at in rng.integers(0, 60, int(rng.integers(0, 5))):
            words[at] = f"y{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words), "en", "s", 1))
    rows += [(100, rows[0][1], "en", "t", 1), (100, rows[0][1], "fr", None, 2), (0, rows[0][1], "de", "u", 3), (0, rows[0][1], None, "a", 3)]
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    want = sorted({rows[g][0] for g in brute_groups([r[1] for r in rows])})
    got = [sorted(map(str, map(tuple, P.simhash_near_dedup(spark, spark.createDataFrame(x, cols).repartition(n), "").collect()))) for x, n in ((rows, 3), (rows[::-1], 5))]
    assert got[0] == got[1] and sorted(int(r.split(",")[0][1:]) for r in got[0]) == want


def test_pairs_equal_direct_count():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, int(rng.integers(100, 200)), replace=False), rng.integers(0, 2**63, int(rng.integers(0, 30))).astype(np.uint64)])) for _ in range(120)] + [base[:3], base[:4], base[:5]]
    fp = np.array([simhash.majority(s) for s in sets], np.uint64)
    at = np.arange(len(sets))
    want = {(a, b) for a in at for b in at if a < b and 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    a, b = simhash.similar_pairs(sets, fp, at, at)
    assert want and set(zip(a.tolist(), b.tolist(), strict=True)) == want
    assert [len(x) for x in simhash.similar_pairs(sets, fp, at[:0], at[:0])] == [0, 0]
    a, b = simhash.similar_pairs(sets, fp, at[:50], at[50:])
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(x, y) for x, y in want if x < 50 <= y}


def test_similar_sets_share_a_cell():
    rng = np.random.default_rng(5)
    for n in (1, 4, 20, 126, 127, 128, 159, 160, 161, 400):
        for _ in range(100):
            both = (8 * n + 8) // 9  # of two sets of n with similarity 0.8 or a little more
            own = n - both
            h = rng.integers(0, 2**63, both + 2 * own).astype(np.uint64) * np.uint64(2)
            a, b = np.unique(h[: both + own]), np.unique(np.concatenate([h[:both], h[both + own :]]))
            assert set(simhash.cells_of(a)) & set(simhash.cells_of(b))
    big = np.unique(rng.integers(0, 2**63, 160).astype(np.uint64))
    assert set(simhash.cells_of(big[:128])) & set(simhash.cells_of(big)) and not simhash.cells_of(big[:0])

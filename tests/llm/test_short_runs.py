"""Line dedup with passages of few lines: any run of lines of min_words words together, by brute force."""

import corpus_pipeline as P
from lamina.llm import line_dedup
from tests.llm.test_operators import WORD, frame, sample


def brute_runs(rows, k, words):
    """As in the operator's tests, but grams are all runs of k lines or of min_words words, of any length."""
    rows = sorted({(i, t) for i, t, *_ in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, dead, full = set(), {r: set() for r in rows}, {}
    for r in rows:
        lines = [] if r[1] is None else r[1].split("\n")
        full[r] = [j for j, x in enumerate(lines) if WORD.search(x)]
        for p in range(len(full[r])):
            for e in range(p + 1, len(full[r]) + 1):
                g = tuple(lines[j] for j in full[r][p:e])
                if e - p >= k or sum(len(WORD.findall(x)) for x in g) >= words:
                    if g in seen:
                        dead[r].update(range(p, e))
                    seen.add(g)
    out = {}
    for r in rows:
        lines, gone = (r[1] or "").split("\n"), set()
        for p in dead[r]:
            gone.update(range(full[r][p], full[r][p + 1] if p + 1 < len(full[r]) else len(lines)))
        out[r] = r[1] and "\n".join(x for j, x in enumerate(lines) if j not in gone)
    return out


def test_runs(spark):
    rows = [r for r in sample() if r[0] is not None]
    for k in (3, 4):
        want = brute_runs(rows, k, 30)
        got = line_dedup.dedup_lines(frame(spark, rows), ["doc_id"], k, 30, short_runs=True).collect()
        assert sorted((r.doc_id, str(r.text)) for r in got) == sorted((i, str(want[(i, t)])) for i, t, *_ in rows)


def test_stage_finds_two_lines(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(20))
    rows = [(1, f"{a}\n{b}"), (2, f"own words\n{a}\n\n{b}\nown end"), (3, f"{a}\n{b}"), (4, a), (5, f"{b}\n{a}")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in P.dedup_lines(spark, docs, "").collect()}
    assert got == {1: rows[0][1], 2: "own words\nown end", 4: a, 5: rows[4][1]}  # 49 words or fewer, or in another order, stay

"""Hard negatives against brute force, over sizes, blocks and edge cases."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import hard_negatives, queries

SF = "/root/testdata/sf0.001"


def brute(rows, is_anchor, positives=5, negatives=10, share=(30, 90)):
    good = []
    for n, (i, label, v) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        c = [math.floor(256 * float(x)) for x in v]
        if sum(x * x for x in c) < 2**62 * 0.999:
            good.append((n, i, label, c))
    out = []
    for n, i, label, c in good:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(c, d, strict=True)), j, lab) for m, j, lab, d in good if m != n and len(d) == len(c)]
        for p, pid, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            fit = sorted(x for x in scored if x[2] != label and share[0] * -p <= 100 * -x[0] <= share[1] * -p)[:negatives]
            out += [(i, pid, k + 1, j, -p, -s) for k, (s, j, _) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, every=5, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % every == 0, **kw).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, monkeypatch, seed):
    """Blocks and tiles of a few rows, many ties and a hot label."""
    monkeypatch.setattr(hard_negatives, "ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 13)
    monkeypatch.setattr(hard_negatives, "LEAST", 2)
    r = np.random.default_rng(seed)
    v = r.normal(size=(300, 6)) + 1.5
    v[::7] = v[0]  # equal vectors
    rows = [(i, int(min(r.integers(0, 5), 2)), [float(np.float32(x)) for x in v[i]]) for i in range(300)]
    want = brute(rows, lambda i: i % 5 == 0)
    assert len(want) > 1000
    assert mined(spark, rows) == want
    # few pairs stay dense
    monkeypatch.setattr(hard_negatives, "SPARSE", 1.1)
    assert mined(spark, rows) == want


def test_selection_drops_early():
    """A pair is dropped when its interval can't qualify: most pairs never have all planes read."""
    r = np.random.default_rng(0)
    c = np.floor(256 * r.normal(size=(2000, 64)) / 8).astype(np.int64)
    a = c[:20]
    s = hard_negatives.Selection(a, np.full((20, 1), 15_000), np.full((20, 1), 60_000), 10)
    read = []
    bounds = s._bounds
    s._bounds = lambda at, partial, left, rest: read.append((left, partial.size)) or bounds(at, partial, left, rest)
    s.add(c, np.arange(2000), np.arange(2000), lambda at: np.ones((20, 2000), bool))
    whole = [n for left, n in read if left == 0]
    assert sum(whole) < 0.05 * 20 * 2000
    i, _, j, score, _ = s.result()
    full = a @ c.T
    for k in range(20):
        fit = sorted((-full[k, m], m) for m in range(2000) if 15_000 <= full[k, m] <= 60_000)[:10]
        assert [(-x, y) for x, y in zip(score[i == k], j[i == k], strict=True)] == fit


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.5, 0.5]), (3, 2, [0.4, 0.2]), (4, 2, [0.4, 0.2]), (5, 3, [0.0, 0.0]), (6, None, [1.0, 1.0]), (7, 2, None), (8, 2, [None, 1.0]),
        (9, 2, [inf, 0.0]), (10, 2, [nan, 0.0]), (None, 2, [0.5, 0.5]), (11, 1, []), (15, 2, []), (20, 1, [1.0, 2.0, 3.0]), (21, 1, [1.0, 2.0, 2.5]), (22, 2, [0.5, 1.0, 1.0]), (25, 4, [-1.0, -1.0]), (26, 4, [1.0, 1.0])]
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and mined(spark, rows) == want
    assert mined(spark, [r for r in rows if r[0] == 26]) == []
    assert mined(spark, []) == []
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<float>, rid int, score string")
    assert sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 5 == 0).collect())) == want


def test_large_components(spark):
    """Sums beyond 53 bits are whole; vectors too long for 64 bits take no part."""
    r = np.random.default_rng(4)
    rows = [(i, int(i % 3), [float(np.float32(x)) for x in r.normal(size=4) * 1e6 + 2e6]) for i in range(40)] + [(40, 1, [1e30, 0.0, 0.0, 0.0])]
    want = brute(rows, lambda i: i % 5 == 0)
    assert len(want) > 100 and mined(spark, rows) == want


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(queries.oracle_sql()["op12_hard_negatives"])
    names = [x[0] for x in want.description]
    got = queries.op12_hard_negatives(spark, SF)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())

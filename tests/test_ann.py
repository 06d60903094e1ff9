"""The index of cells: recall against the exact search, hot cells, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.operators import ann
from lamina.operators.vectors import cosine_topk


def frame(spark, x):
    return spark.createDataFrame([(i, [float(np.float32(y)) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")


def recall(near, exact):
    hits = near.join(exact, ["query_id", "vec_id"], "left_semi").count()
    return hits / exact.count()


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters of unlike sizes, one with a third of all vectors."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(40, 16)) * 2
    which = np.where(r.random(2500) < 0.33, 0, r.integers(0, 40, 2500))
    return frame(spark, centres[which] + r.normal(size=(2500, 16))).cache()


def test_recall_and_blocks(spark, vectors, tmp_path):
    path = f"file://{tmp_path}/cells"
    cells = ann.build(vectors, path, target=0.95)
    assert len(cells.centres) == 50 and cells.recall >= 0.95 and cells.visits < 25
    queries = vectors.filter("vec_id % 20 = 0")
    exact = cosine_topk(queries, vectors, 10)
    near = ann.search(queries, path, cells, 10)
    rows = sorted(map(tuple, near.collect()))
    assert near.groupBy("query_id").count().filter("count <> 10").count() == 0
    assert recall(near, exact) >= 0.9
    # small blocks: the cell with a third of the vectors is cut on both sides, and the result is the same
    assert sorted(map(tuple, ann.search(queries, path, cells, 10, block=50).collect())) == rows
    # every cell visited: the exact result
    whole = ann.Cells(cells.centres, len(cells.centres), 1.0)
    assert sorted(map(tuple, ann.search(queries, path, whole, 10).collect())) == sorted(map(tuple, exact.collect()))


def test_edges(spark, tmp_path):
    rows = [(i, v) for i, v in enumerate([[1.0, 0.0], [1.0, 0.0], [0.9, 0.1], [0.0, 1.0], None, [0.0, 0.0], [float("nan"), 1.0], [None, 1.0], [-1.0, 0.0]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit("x"))
    cells = ann.build(df, f"file://{tmp_path}/a", k=2)
    got = ann.search(df, f"file://{tmp_path}/a", ann.Cells(cells.centres, len(cells.centres), 1.0), 2)
    assert sorted(map(tuple, got.select("query_id", "vec_id", "rank").collect())) == sorted(map(tuple, cosine_topk(df, df, 2).select("query_id", "vec_id", "rank").collect()))
    none = ann.build(df.limit(0), f"file://{tmp_path}/b")
    assert ann.search(df, f"file://{tmp_path}/b", none, 2).count() == 0
    with pytest.raises(ValueError, match="one length"):
        ann.build(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>"), f"file://{tmp_path}/c")

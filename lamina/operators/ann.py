"""Approximate nearest neighbours: vectors in cells around k-means centres, as many cells searched as the measured recall asks for, exact cosines within them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import _best, _ranked, _taken, cosine_topk, sound

#: Vectors for each centre that the centres are fitted on, about; and how many bytes of centres a task may get (their number is the root of the vectors').
SAMPLED, CENTRES = 64, 256 * 2**20
#: Vectors whose exact neighbours tell how many cells to search.
PROBED = 200


@dataclass
class Cells:
    """Centres of unit length, how many of them a query visits, and the recall that this had on the vectors it was chosen by."""

    centres: np.ndarray
    visits: int
    recall: float

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest centres of each row of x, nearest first; ties by number."""
        if len(self.centres) == 1:
            return np.zeros((len(x), 1), int)
        near = -(x / np.sqrt((x * x).sum(1, keepdims=True))) @ self.centres.T
        return np.argsort(near, 1, kind="stable")[:, :n]


def _in_cells(df: DataFrame, cells: Cells, n: int) -> DataFrame:
    """Rows (side, id, dims, v) with each of their n nearest cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                x = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                near = cells.nearest(x, n).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(near), pa.list_(pa.int32()))], [*b.schema.names, "cells"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, cells array<int>").withColumn("cell", F.explode("cells")).drop("cells")


def build(vectors: DataFrame, path: str, target: float = 0.95, k: int = 10, seed: int = 5) -> Cells:
    """Index vectors (vec_id, embedding) at `path`, in the order of their cells, and choose how many cells a query visits.

    Centres: k-means with cosines on a sample of about SAMPLED vectors a centre, as many as the root of the number of vectors. All sound vectors are
    indexed, each in the cell of its nearest centre. Visits: PROBED vectors are searched exactly, and as many cells are visited as hold `target` of their k neighbours. Vectors
    must have one length; those without a direction are left out. An empty table has one empty cell.
    """
    spark, src = vectors.sparkSession, _taken(vectors, 1)
    n, dims = src.agg(F.count("*"), F.max("dims")).first()
    if not n:
        src.withColumn("cell", F.lit(0)).write.mode("overwrite").parquet(path)
        return Cells(np.ones((1, 1)), 1, 1.0)
    if src.filter(F.col("dims") != dims).limit(1).count():
        raise ValueError("vectors of one length are needed")
    centres = max(1, round(n**0.5))
    if centres * dims * 8 > CENTRES:
        raise ValueError(f"{centres} centres of {dims} numbers are more than tasks may get: index parts of the table apart")
    share = min(1.0, SAMPLED * centres / n)
    some = src.filter(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    fitted = KMeans(k=centres, seed=seed, maxIter=10, initMode="random", distanceMeasure="cosine", featuresCol="x").fit(some.select(array_to_vector("v").alias("x")))
    c = np.array(fitted.clusterCenters())
    c = c[np.sqrt((c * c).sum(1)) > 0]
    cells = Cells(c / np.sqrt((c * c).sum(1, keepdims=True)), 1, 0.0)
    _in_cells(src, cells, 1).repartitionByRange("cell", "id").sortWithinPartitions("cell").write.mode("overwrite").parquet(path)
    placed = spark.read.parquet(path)
    probes = vectors.filter(sound()).orderBy(F.xxhash64(F.lit(seed + 1), "vec_id")).limit(PROBED)
    truth = cosine_topk(probes, vectors, k).join(placed.select(F.col("id").alias("vec_id"), "cell"), "vec_id").select("query_id", "cell").collect()
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in probes.select("vec_id", "embedding").collect()}
    order = {i: {int(cell): at for at, cell in enumerate(cells.nearest(v[None], len(c))[0])} for i, v in x.items()}
    ranks = np.array([order[r["query_id"]][r["cell"]] for r in truth] or [0])
    visits = int(np.quantile(ranks, target, method="higher")) + 1
    return Cells(cells.centres, visits, float((ranks < visits).mean()))


def search(queries: DataFrame, path: str, cells: Cells, k: int, block: int = 16_384) -> DataFrame:
    """cosine_topk() by the index: (query_id, vec_id, rank, cosine), exact cosines of what the visited cells hold.

    A query goes to its cells, and meets what rests there in tasks of bounded size: cells with many vectors or many visitors are cut into blocks on either side, so that one that
    holds a third of all vectors is no task of its own. Queries of another length than the index find nothing.
    """
    placed = queries.sparkSession.read.parquet(path)
    asked = _in_cells(_taken(queries, 0).filter(F.col("dims") == cells.centres.shape[1]), cells, cells.visits)
    blocks = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    # one row for each cell; the root of the number of vectors
    sizes = blocks(placed, "rest").join(blocks(asked, "call"), "cell")
    deal = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = asked.join(sizes, "cell").withColumn("a", deal("call")).withColumn("b", every("rest"))
    right = placed.join(sizes, "cell").withColumn("b", deal("rest")).withColumn("a", every("call"))
    both = left.select("side", "id", "v", "cell", "a", "b").unionByName(right.select("side", "id", "v", "cell", "a", "b"))
    id_type = both.schema["id"].dataType.simpleString()
    return _ranked(both.groupBy("cell", "a", "b").applyInArrow(_best(k), f"query_id {id_type}, vec_id {id_type}, cosine double"), k)

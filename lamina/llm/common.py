"""Helpers shared by the operators: shared tables, seeds, token rules, components."""

from __future__ import annotations

import atexit
import contextlib
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_own: dict[str, str] = {}
#: Tables of each application that spill() wrote and nothing has deleted.
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on a local master only, one of our own where it is unset (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="lamina-")
        atexit.register(shutil.rmtree, _own[app], True)
    return "file://" + _own[app]


def row_key(*columns: str):
    """128 bits that stand for the values of columns, nulls told apart; of 10**10 different rows two share them once in 10**18."""
    text = lambda c: F.col(c).cast("string")
    parts = [F.coalesce(F.concat(F.octet_length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat(*parts)))


def free(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished jobs (it does so when their plans are collected). In a local session, where they are small, that can wait."""
    if spark.sparkContext.master.startswith("local["):
        return
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spill(df: DataFrame, label: str, partition_by: list[str] | None = None, tidy: bool = True) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back; tidy: free shuffle files of the steps before first.

    This cuts lineage: a lost executor costs the tasks it ran, not the jobs before. It also
    puts a plain scan under later joins, so that AQE can split their skewed partitions.
    """
    spark = df.sparkSession
    if tidy:
        free(spark)  # what the step before left: its plan is collectable only now
    path = f"{shared_dir(spark)}/lamina/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    writer = df.write.option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    del df, writer
    out = spark.read.schema(schema).parquet(path)
    out._lamina_path = path
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


def spill_bucketed(df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
    """spill(), with the rows of each of so many hashes of the column in files of their own: grouping the result by the column, also together with another table, doesn't move it again."""
    spark = df.sparkSession
    name = f"lamina_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/lamina/{label}-{name}"
    df.write.option("compression", "snappy").option("path", path).bucketBy(buckets, column).saveAsTable(name)
    out = spark.table(name).select("*")
    out.schema  # resolved: the files are all it needs from here on
    spark.sql(f"DROP TABLE {name}")
    out._lamina_path = path
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


def drop_spilled(*tables: DataFrame) -> None:
    """Delete tables that spill() wrote and nothing reads any more: what was made of them is written itself."""
    for df in tables:
        _delete(df.sparkSession, df._lamina_path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    with contextlib.suppress(ValueError):
        _written.get(spark.sparkContext.applicationId, []).remove(path)


def spilled(spark: SparkSession) -> list[str]:
    """Tables that spill() wrote and nothing has deleted, oldest first."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def drop_all_but(spark: SparkSession, keep: list[str]) -> None:
    """Delete all of spilled() but these: when a result is written, what its steps wrote can go."""
    for path in spilled(spark):
        if path not in keep:
            _delete(spark, path)


def trim() -> None:
    """Give freed memory of this Python worker back to the system: workers live on, and large arrays leave gaps that the allocator keeps."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def buckets_for(rows: int, per_bucket: int, least: int = 48) -> int:
    """How many hash buckets hold about per_bucket rows each; grows with the rows."""
    return max(least, -(-rows // per_bucket))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v), both long: one row (id, component) per vertex, component its smallest vertex.

    Alternating large-star and small-star steps (Kiveris et al. 2014). Minima are pre-aggregated
    and written first, so the join of a hub's edges with its minimum is a join of two
    scans, which AQE splits when one vertex has most of the edges.
    """
    def canonical(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    cur = spill(canonical(edges), "cc")
    old = digest(cur)
    while old[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = spill(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-min")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = spill(canonical(large), "cc-large")
        low2 = spill(nxt.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        small = nxt.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select("u", F.col("m").alias("v")))
        after = spill(canonical(small), "cc")
        drop_spilled(cur, low, nxt, low2)
        cur, new = after, digest(after)
        if new == old:
            break
        old = new
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def union_find(n: int, a, b):
    """Smallest index of each of n nodes' component, given edge arrays a, b; vectorised min-label hooking with pointer jumping."""
    import numpy as np

    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        live = ra != rb
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        if not len(a):
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root

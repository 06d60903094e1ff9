"""Sharding: a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spill

VNODES = 128
#: Each arc of the ring is cut into 2**6 cells when its rows are ranked, so that no sort holds a whole arc.
CELL_BITS = 6
RANK_BITS = 44


class Ring:
    """shards * vnodes points on the circle of 64-bit hashes; arc i ends at point i, whose owner is its first shard."""

    def __init__(self, shards: int, vnodes: int = VNODES, seed: int = 11):
        points = sorted((xxhash.xxh64_intdigest(f"{s}/{v}", seed), s) for s in range(shards) for v in range(vnodes))
        self.shards = shards
        self.points = np.array([p for p, _ in points], np.uint64)
        self.owners = np.array([s for _, s in points], np.int32)

    def arc(self, h: np.ndarray) -> np.ndarray:
        """Arc of each 64-bit hash: the first point clockwise from it."""
        return np.searchsorted(self.points, h.view(np.uint64), side="left") % len(self.points)


def place(ring: Ring, counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each arc go: segments (arc, first rank, shard, first slot, hops), given the rows of each arc.

    A shard's bound is its share of all rows, rounded up for the first (rows mod shards) shards and down for
    the others. In each round every arc offers what it has left to the shard it stands at, in ring
    order; what doesn't fit goes on clockwise to the next point. The bounds add up to all rows, so all
    shards end full: counts are at most one apart. Input and output are bounded by the ring, not by the data.
    """
    n, points = int(counts.sum()), len(ring.points)
    free = [n // ring.shards + (s < n % ring.shards) for s in range(ring.shards)]
    slot = [0] * ring.shards
    rest = {i: int(c) for i, c in enumerate(counts) if c}
    rank = dict.fromkeys(rest, 0)
    segments, hops = [], 0
    while rest:
        for i in list(rest):
            s = int(ring.owners[(i + hops) % points])
            if take := min(rest[i], free[s]):
                segments.append((i, rank[i], s, slot[s], hops))
                free[s] -= take
                slot[s] += take
                rank[i] += take
                rest[i] -= take
                if not rest[i]:
                    del rest[i]
        hops += 1
    return sorted(segments)


def shard(docs: DataFrame, shards: int, vnodes: int = VNODES, seed: int = 11) -> DataFrame:
    """Deal rows to shards: (doc_id, size, text_crc32, ring_shard, hops, shard, slot).

    A row stands on the ring at the hash of its doc_id and belongs to the first shard clockwise
    (ring_shard) unless that is full; see place(). Within an arc, rows go in the order of a hash of the
    row. size: UTF-8 bytes of the text plus 8; a null text has size 8 and the checksum of no bytes. A null doc_id is a
    key like any other. Rows that repeat are dealt one by one, and equal texts of several documents by their ids: the law `rows` asks for equal
    counts, not for equal texts to meet. An empty table gives an empty result. Very long texts count by their bytes; other columns are not read.
    The driver gets one count for each of the shards * vnodes arcs.
    """
    ring = Ring(shards, vnodes, seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    src = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(F.lit(seed), "doc_id").alias("h"))
    src = src.withColumn("g", F.xxhash64("h", "size", "text_crc32"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arcs = ring.arc(b.column(3).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], b.column(4), pa.array(arcs.astype(np.int32))], ["doc_id", "size", "text_crc32", "g", "arc"])

    base = src.mapInArrow(locate, f"doc_id {kind}, size long, text_crc32 long, g long, arc int")
    base = spill(base.withColumn("cell", F.shiftrightunsigned("g", 64 - CELL_BITS).cast("int")), "shard-base")
    cells = spill(base.groupBy("arc", "cell").agg(F.count("*").alias("n")), "shard-cells")
    counts = np.zeros(len(ring.points), np.int64)
    for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect():
        counts[r.arc] = r.n
    seg = np.array(place(ring, counts), np.int64).reshape(-1, 5)
    keys = (seg[:, 0] << RANK_BITS) + seg[:, 1]

    before = F.coalesce(F.sum("n").over(Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select("arc", "cell", before.alias("before"))
    nth = F.row_number().over(Window.partitionBy("arc", "cell").orderBy("g", "doc_id")) - 1
    ranked = base.withColumn("nth", nth).join(cells, ["arc", "cell"]).select("doc_id", "size", "text_crc32", "arc", (F.col("nth") + F.col("before")).cast("long").alias("rank"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arc, rank = b.column(3).to_numpy(zero_copy_only=False).astype(np.int64), b.column(4).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (arc << RANK_BITS) + rank, side="right") - 1
            s = seg[at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(ring.owners[arc]), pa.array(s[:, 4].astype(np.int32)), pa.array(s[:, 2].astype(np.int32)), pa.array(s[:, 3] + rank - s[:, 1])],
                ["doc_id", "size", "text_crc32", "ring_shard", "hops", "shard", "slot"],
            )

    return ranked.mapInArrow(deal, f"doc_id {kind}, size long, text_crc32 long, ring_shard int, hops int, shard int, slot long")

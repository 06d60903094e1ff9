"""Best-fit packing into token sequences: linear grouping of the large pieces, best fit of the small ones."""

from __future__ import annotations

import json
import os
import re
import sys
import warnings
import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spill

CAPACITY, END = 1024, 2
#: Pieces over CAPACITY // LARGE are large; they are grouped into at most GROUPS sizes, and the configurations are
#: improved until no other helps; after PIVOTS steps with a warning.
LARGE, GROUPS, PIVOTS = 16, 128, 5000
#: Pieces of a cell, about: pieces of a length fall into cells when they are ranked, so that no sort holds a whole length.
CELL = 50_000
RANK_BITS = 48
#: Fixed value: how byte-level BPE of this kind cuts text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts left to the tokenizer itself: characters past Latin, whose classes the two libraries might see differently, and marks of special tokens.
_LEAVE = re.compile(r"[^\x00-\u024f]|<\|")


class Encoder:
    """Token ids of a text as little-endian 32-bit bytes, equal to those of the tokenizer file.

    Where the file is a byte-level BPE whose ids follow the order of its merges, as a rule, its vocabulary also runs in
    tiktoken, several times as fast; that is used for Latin text. All else goes to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = self._fast(path)

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One encoder for a worker process: a Python worker runs many tasks, and each new copy of the vocabulary would stay in its memory."""
        known = vars(sys).setdefault("_lamina_encoders", {})
        if path not in known:
            known[path] = cls(path)
        return known[path]

    @staticmethod
    def _fast(path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
        vocab = model["vocab"]
        ordered = all(vocab.get(m.replace(" ", "")) == 256 + i for i, m in enumerate(merges))
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec["normalizer"]
        if not (ordered and plain):
            return None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.fast is None or _LEAVE.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, keep: list[str], capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(keep..., piece, start, length, ids_crc32[, ids]): every document's tokens and the end token, longer ones cut so that only the first piece is short."""
    src = docs.select(*keep, "text")
    k = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder.of(tokenizer)
        end = np.array([END], "<u4").tobytes()
        for b in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, text in enumerate(b.column(k).to_pylist()):
                data = encode(text) + end
                n, at = len(data) // 4, 0
                size = (n - 1) % capacity + 1
                for i in range(-(-n // capacity)):
                    part = data[4 * at : 4 * (at + size)]
                    for out, x in zip((row, piece, start, length, crc), (r, i, at, size, zlib.crc32(part)), strict=True):
                        out.append(x)
                    if with_ids:
                        ids.append(part)
                    at, size = at + size, capacity
            at = pa.array(row, pa.int64())
            cols = [*(b.column(i).take(at) for i in range(k)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [*keep, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    head = "".join(f"`{c}` {src.schema[c].dataType.simpleString()}, " for c in keep)
    return src.mapInArrow(run, f"{head}piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def best_config(sizes: list[int], values: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is taken to get the most value within the capacity (unbounded knapsack)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i, s in enumerate(sizes):
        if values[i] <= 1e-12:
            continue
        for at in range(s, capacity + 1, s):
            to = min(at + s, capacity + 1)
            new = best[at - s : to - s] + values[i]
            up = new > best[at:to] + 1e-12
            best[at:to][up] = new[up]
            last[at:to][up] = i
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while last[c] >= 0:
        counts[last[c]] += 1
        c -= sizes[last[c]]
    return counts


def configurations(sizes: list[int], demand: np.ndarray, capacity: int, pivots: int = PIVOTS) -> list[tuple[np.ndarray, int]]:
    """(counts by size, whole number of sequences): the linear program of configurations by column generation, rounded down."""
    k = len(sizes)
    if not k:
        return []
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    inv = np.diag(1 / np.diag(basis))
    # einsum, as threaded linear algebra can hang in a process that has forked (the JVM's start)
    times = lambda v: np.einsum("ij,j->i", inv, v)
    for step in range(pivots + 1):
        if step == pivots:
            warnings.warn(f"configurations not improved further after {pivots} steps", stacklevel=2)
            break
        duals = inv.sum(0)
        column = best_config(sizes, duals, capacity)
        if (duals * column).sum() <= 1 + 1e-7:
            break
        u, x = times(column.astype(float)), times(demand)
        ratio = np.where(u > 1e-9, np.maximum(x, 0) / np.where(u > 1e-9, u, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        row = inv[out] / u[out]
        inv -= np.outer(u, row)
        inv[out] = row
    x = np.floor(np.maximum(times(demand), 0) + 1e-6).astype(np.int64)
    left, out = demand.astype(np.int64).copy(), []
    for c in range(k):
        counts = basis[:, c].astype(np.int64)
        used = counts > 0
        n = min(int(x[c]), int((left[used] // counts[used]).min()))
        if n > 0:
            left -= n * counts
            out.append((counts, n))
    return out


def plan(hist: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, count, first sequence, pieces in a sequence, offset), from the number of pieces of each length.

    Linear grouping: large lengths in descending order fall into groups of equal cardinality, all rounded up to the
    largest; configurations of these few sizes are optimised; the actual pieces take the places of their group; what
    is left, and the small ones, go by best fit to the fullest sequences that have room. Sequences filled alike are
    handled together as one class, so the work depends on the number of lengths and not of pieces.
    """
    rank = dict.fromkeys(hist, 0)  # pieces of each length that have a place
    classes: list[tuple[int, list[tuple[int, int, int]]]] = []  # (sequences, [(length, first rank, pieces each)])
    room: dict[int, list[int]] = {}
    open_rooms: list[int] = []

    def add(n: int, items: list[tuple[int, int, int]]) -> None:
        if n:
            r = capacity - sum(size * q for size, _, q in items)
            if r not in room or not room[r]:
                insort(open_rooms, r)
            room.setdefault(r, []).append(len(classes))
            classes.append((n, items))

    large = sorted((x for x in hist if capacity // LARGE < x < capacity and hist[x]), reverse=True)
    total = sum(hist[x] for x in large)
    groups: list[list[list[int]]] = []  # of each group: [length, pieces]
    share, filled = -(-total // GROUPS) if total else 1, 0
    for x in large:
        n = hist[x]
        while n:
            if not groups or filled == share:
                groups.append([])
                filled = 0
            take = min(n, share - filled)
            groups[-1].append([x, take])
            filled, n = filled + take, n - take
    merged: dict[int, list[list[int]]] = {}  # groups with one rounded size are one
    for g in groups:
        merged.setdefault(g[0][0], []).extend(g)
    sizes = sorted(merged, reverse=True)
    queues = [merged[s] for s in sizes]
    demand = np.array([sum(n for _, n in q) for q in queues], float)
    for counts, n in configurations(sizes, demand, capacity):
        slots = [i for i in np.flatnonzero(counts) for _ in range(counts[i])]
        while n:
            # as many sequences as have the same lengths in all their places
            need = {i: int(counts[i]) for i in set(slots)}
            m = min([n, *(queues[i][0][1] // q for i, q in need.items())])
            items = []
            for i, q in need.items():
                if m:
                    size = queues[i][0][0]
                    items.append((size, rank[size], q))
                    rank[size] += m * q
                    queues[i][0][1] -= m * q
                else:  # one sequence that takes the last pieces of a length and the first of the next
                    for _ in range(q):
                        while not queues[i][0][1]:
                            queues[i].pop(0)
                        size = queues[i][0][0]
                        items.append((size, rank[size], 1))
                        rank[size] += 1
                        queues[i][0][1] -= 1
                while queues[i] and not queues[i][0][1]:
                    queues[i].pop(0)
            add(max(m, 1), items)
            n -= max(m, 1)
    for x in sorted(hist, reverse=True):
        n = hist[x] - rank[x]
        while n:
            at = next((r for r in open_rooms if r >= x), None) if x < capacity else None
            if at is None:
                q = min(capacity // x, n)
                m, items = n // q, []
            else:
                c = room[at].pop()
                if not room[at]:
                    open_rooms.remove(at)
                m, items = classes[c]
                classes[c] = (0, [])
                q = min(at // x, n)
                if m * q > n:
                    keep = n // q
                    add(m - keep, [(s, r + keep * k, k) for s, r, k in items])
                    m = keep
            add(m, [*items, (x, rank[x], q)])
            rank[x] += m * q
            n -= m * q
    runs, sequence = [], 0
    for n, items in classes:
        offset = 0
        for size, first, q in items:
            runs.append((size, first, n * q, sequence, q, offset))
            offset += size * q
        sequence += n
    return np.array(sorted(runs), np.int64).reshape(-1, 6)


def pack(docs: DataFrame, tokenizer: str, keep: list[str] | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pack all documents: (keep..., piece, start, length, ids_crc32[, ids], sequence_id, offset), one row per piece.

    A null or empty text is its end token alone. Rows that repeat are packed one by one. An empty table gives
    an empty result. The driver gets the number of pieces of each length, at most `capacity` numbers, and plans on
    these; a piece finds its place by its rank among the pieces of its length. A piece of the whole capacity is a sequence by itself, and is
    neither ranked nor moved. Of very long texts one at a time is held, with its ids. Columns of keep can't have names of the result.
    """
    keep = list(keep or ["doc_id"])
    key = F.xxhash64(*keep, "piece", "start", "ids_crc32")
    every = spill(pieces(docs, tokenizer, keep, capacity, with_ids).withColumn("h", key), "pack-pieces")
    counts = {r["length"]: r["n"] for r in every.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` numbers at most
    names = [*keep, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    full = counts.pop(capacity, 0)
    runs = plan(counts, capacity)
    keys = (runs[:, 0] << RANK_BITS) + runs[:, 1]
    # pieces that fill a sequence need no rank: any number after the planned ones that no other has
    planned = int((runs[:, 3] + (runs[:, 2] + runs[:, 4] - 1) // runs[:, 4]).max(initial=0))
    alone = every.filter(F.col("length") == capacity).select(*names, (F.monotonically_increasing_id() + planned).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    bits = max(0, (max(counts.values(), default=0) // CELL).bit_length())
    cell = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    cut = every.filter(F.col("length") < capacity).withColumn("cell", cell)
    cells = spill(cut.groupBy("length", "cell").agg(F.count("*").alias("n")), "pack-cells")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select("length", "cell", before.alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "cell").orderBy("h")) - 1
    ranked = cut.withColumn("nth", nth).join(cells, ["length", "cell"]).select(*names, (F.col("nth") + F.col("before")).cast("long").alias("rank"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = (b.column(names.index("length")).to_numpy(zero_copy_only=False), b.column(len(names)).to_numpy(zero_copy_only=False))
            r = runs[np.searchsorted(keys, (size << RANK_BITS) + rank, side="right") - 1]
            nth = rank - r[:, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(r[:, 3] + nth // r[:, 4]), pa.array(r[:, 5] + nth % r[:, 4] * size)], [*names, "sequence_id", "offset"])

    head = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in names)
    packed = ranked.mapInArrow(deal, f"{head}, sequence_id long, offset long")
    return packed.unionByName(alone) if full else packed

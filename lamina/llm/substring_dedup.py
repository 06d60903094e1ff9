"""Suffix-array dedup: repeated byte strings found by column-wise construction over aligned segments.

One symbol of every document a round, over whole documents, would take as many rounds as the longest document has
bytes, each a pass over the files of the whole collection. So the collection is first cut into
segments that can be ordered apart. Every string of `length` bytes holds a selected anchor (the smallest hash of
its grams), and equal strings hold equal anchors at equal places; so all strings that could be equal
lie in segments around one anchor, and there they start in the same column. Segments of an anchor are the
documents of the construction: from the last column to the first, each round puts one symbol before every
segment's suffix, and the order (the collection's transform) and the common prefixes of neighbours are updated from
those of the round before. A string is repeated where the common prefix with a neighbour has its length.
Segments that are equal as a whole are one with a count. The parts go through tables in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, drop_spilled, spill
from .katz import mix

LENGTH, GRAM = 400, 120
#: Segments of a task's bucket, about, and parts that the occurrences of a segment are dealt to.
BUCKET, SALTS = 3000, 8
#: An anchor with more distinct segments than this is divided by longer grams.
WIDE = 20_000
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse mod 2**64, at least n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        steps = np.ones((2, size), np.uint64)
        steps[0, 1:], steps[1, 1:] = np.uint64(_BASE), np.uint64(inverse)
        _powers[:] = list(np.cumprod(steps, 1, dtype=np.uint64))
    return _powers[0][:n], _powers[1][:n]


def anchors(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first start, last start) of the anchors of a text's strings of `length` bytes.

    The anchor of a string is the smallest hash of its grams, the rightmost of equal ones. Anchors move on with the starts,
    so the starts of one anchor are a range.
    """
    n, w = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none.view(np.uint64), none, none, none
    power, inverse = _base_powers(n + 1)
    s = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(s * power[:n], dtype=np.uint64)])
    h = mix((total[gram:] - total[:-gram]) * inverse[: n - gram + 1])
    # sliding minima by prefix and suffix minima of blocks of w; windows start at 0 .. n - length
    count = len(h)
    rows = -(-count // w)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.concatenate([h, np.full(rows * w - count, top)]).reshape(rows, w)
    left = np.minimum.accumulate(padded, 1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    starts = np.arange(n - length + 1)
    low = np.minimum(right[starts], left[starts + w - 1])
    # the rightmost place of the minimum: the last place up to the window's end that has this value
    change = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    where, first = [], []
    order = np.argsort(h, kind="stable") if len(change) > 1 else np.arange(count)
    ordered = h[order] if len(change) > 1 else h
    ends = np.append(change[1:], len(low))
    for a, b in zip(change.tolist(), ends.tolist(), strict=True):
        v = low[a]
        if len(change) > 1:
            spots = order[np.searchsorted(ordered, v, "left") : np.searchsorted(ordered, v, "right")]
        else:
            spots = np.flatnonzero(h == v)
        if len(spots) == 1:
            where.append(int(spots[0]))
            first.append(a)
            continue
        # the place for each start: last spot within start + w - 1
        at = spots[np.searchsorted(spots, starts[a:b] + w - 1, "right") - 1]
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        where.extend(at[new].tolist())
        first.extend((a + new).tolist())
    where, first = np.array(where), np.array(first)
    last = np.append(first[1:], len(starts)) - 1
    return h[where], where, first, last


def repeated_starts(codes: np.ndarray, group: np.ndarray, length: int, columns: int) -> np.ndarray:
    """Which strings of `length` symbols occur twice in a group: (segments, columns), true where one starts there.

    codes: a row of symbols for each segment, aligned, 0 where it has none; groups are apart. Right to left, each round
    puts a column's symbol before all suffixes: the new order is the old one sorted by symbol, stable, and the common
    prefix of new neighbours with equal symbols is one more than the least between them in the old order.
    """
    m, width = codes.shape
    out = np.zeros((m, columns), bool)
    order = np.argsort(group, kind="stable")
    lcp = np.zeros(m, np.int32)
    key_of = group.astype(np.int64) * 512
    for x in range(width - 1, -1, -1):
        code = codes[order, x]
        key = key_of[order] + code
        to = np.argsort(key, kind="stable")
        if m > 1:
            same = np.concatenate([[False], (key[to][1:] == key[to][:-1]) & (code[to][1:] > 0)])
            a = to[same]
            b = to[np.flatnonzero(same) - 1]
            new = np.zeros(m, np.int32)
            new[same] = 1 + _least(lcp, b + 1, a)
            lcp = new
        order = order[to]
        if x < columns:
            far = lcp >= length
            far[:-1] |= far[1:]  # and the neighbour before
            out[order[far], x] = True
    return out


def _least(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of v[a..b], both included; a sparse table as deep as the widest range."""
    out = v[a]
    span = b - a + 1
    wide = int(span.max(initial=1))
    level, step = v, 1
    while True:
        fit = (span >= step) & (span < 2 * step)
        if fit.any():
            out[fit] = np.minimum(level[a[fit]], level[b[fit] - step + 1])
        if 2 * step > wide:
            return out
        level = np.minimum(level[:-step], level[step:]) if len(level) > step else level
        step *= 2


def spans_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values: (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def cut(data: bytes, starts: list[tuple[int, int]], length: int) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, what is left) when the strings at these ranges of starts go."""
    keep, at, removed, runs, end = [], 0, 0, 0, -1
    for a, b in sorted(starts):
        b += length
        if a > end:
            runs += 1
            keep.append(data[at:a])
            removed += b - a
            end = at = b
        elif b > end:
            removed += b - end
            end = at = b
    return removed, runs, b"".join([*keep, data[at:]])


def _level(texts: DataFrame, length: int, gram: int, wide: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(ranges of repeated starts, segments of anchors with over `wide` of them, tables to delete at last) of texts (key, k2, off, n, data).

    off: where data begins in its document; n: how often data occurs. The ranges (key, k2, a, b) are of texts with n = 1: what a text that
    occurs more often holds is known to be repeated. Segments come as texts, to be divided by longer grams.
    """
    names = ["h", "key", "k2", "off", "n", "p", "lo", "hi", "seg"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in names]
            for k, k2, off, n, data in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                h, p, lo, hi = anchors(data, length, gram)
                part = [[x] * len(h) for x in (k, k2, off, n)]
                for c, x in zip(cols, (h.view(np.int64).tolist(), *part, (p + off).tolist(), (lo + off).tolist(), (hi + off).tolist()), strict=False):
                    c.extend(x)
                cols[8].extend(xxhash.xxh3_128_digest(data[a : z + length], q - a) for q, a, z in zip(p.tolist(), lo.tolist(), hi.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if x == "k2" else pa.binary() if x == "seg" else pa.int64()) for x, c in zip(names, cols, strict=True)], names)

    found = texts.filter(F.length("data") >= length).select("key", "k2", "off", "n", "data").mapInArrow(mark, "h long, key long, k2 int, off long, n long, p long, lo long, hi long, seg binary")
    marked = spill(found, "sub-anchors")
    # equal segments are summed up before anything is joined: a passage in a third of all documents is one row from each task
    one = F.min(F.struct("key", "k2", "off", "lo", "hi", "p")).alias("one")
    segs = spill(marked.groupBy("h", "seg").agg(F.sum("n").alias("n"), one), "sub-segs")
    # segments found twice: every string in them is repeated. A frequent one is dealt to SALTS parts: what a task writes of
    # it can't be split any more, and a file of repeated rows is small, so one task may read very many
    salt = F.pmod(F.xxhash64("key", "p"), F.lit(SALTS)).cast("int").alias("salt")
    again = segs.filter("n > 1").select("h", "seg", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    twice = marked.filter("n = 1").select("h", "seg", salt, "key", "k2", "lo", "hi").join(again.hint("merge"), ["h", "seg", "salt"]).select("key", "k2", F.col("lo").alias("a"), F.col("hi").alias("b"))
    # segments found once are compared with the other segments of their anchor
    sizes = spill(segs.groupBy("h").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter("m > 1 and least = 1").select("h", "m"), "sub-sizes")
    open_ = spill(segs.join(sizes.hint("merge"), "h").select("h", "m", "n", "one.*"), "sub-open")
    wanted = open_.groupBy("key", "k2", "off").agg(F.collect_list(F.struct("h", "m", "n", "lo", "hi", "p")).alias("segs"))  # of one text
    n = buckets_for(open_.count(), BUCKET)
    fetched = texts.select("key", "k2", "off", "data").join(wanted.hint("merge"), ["key", "k2", "off"])
    cut_names = ["h", "m", "n", "key", "k2", "lo", "p", "data"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = [(s["h"], s["m"], s["n"], k, k2, s["lo"], s["p"], data[s["lo"] - off : s["hi"] - off + length]) for k, k2, off, data, segs in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True) for s in segs]
                cols = list(zip(*rows, strict=True)) or [()] * len(cut_names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if x == "k2" else pa.binary() if x == "data" else pa.int64()) for x, c in zip(cut_names, cols, strict=True)], cut_names)

    # anchors with many segments have a bucket each, so that several of them don't meet in one task
    bucket = F.when(F.col("m") > BUCKET // 4, n + F.pmod(F.xxhash64("h"), F.lit(1 << 30))).otherwise(F.pmod(F.xxhash64("h"), F.lit(n))).cast("int")
    cutout = spill(fetched.select("key", "k2", "off", "data", "segs").mapInArrow(fetch, "h long, m long, n long, key long, k2 int, lo long, p long, data binary").withColumn("bucket", bucket), "sub-segments")

    def build(t: pa.Table) -> pa.Table:
        h, count, key, k2, lo, p = (t.column(c).to_numpy() for c in ("h", "n", "key", "k2", "lo", "p"))
        data = t.column("data").to_pylist()
        _, group = np.unique(h, return_inverse=True)
        before = length - gram  # a string starts at most this far before its anchor
        rows: list[tuple[int, int, int, int]] = []
        order = np.argsort(group, kind="stable")
        at = 0
        while at < len(order):
            # whole groups, about BUCKET segments at a time
            end = min(at + BUCKET, len(order))
            while end < len(order) and group[order[end]] == group[order[end - 1]]:
                end += 1
            part = order[at:end]
            codes = np.zeros((len(part), before + length), np.uint16)
            for r, i in enumerate(part.tolist()):
                x = before - int(p[i] - lo[i])
                codes[r, x : x + len(data[i])] = np.frombuffer(data[i], np.uint8).astype(np.uint16) + 1
            flags = repeated_starts(codes, group[part], length, before + 1)
            for r, i in enumerate(part.tolist()):
                if count[i] == 1 and flags[r].any():
                    shift = int(p[i]) - before
                    rows.extend((int(key[i]), int(k2[i]), a + shift, b + shift) for a, b in spans_of(flags[r]))
            at = end
        cols = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table({c: pa.array(x, pa.int32() if c == "k2" else pa.int64()) for c, x in zip(("key", "k2", "a", "b"), cols, strict=True)})

    built = cutout.filter(F.col("m") <= wide).groupBy("bucket").applyInArrow(build, "key long, k2 int, a long, b long")
    rest = cutout.filter(F.col("m") > wide).select("key", "k2", F.col("lo").alias("off"), "n", "data")
    return twice.unionByName(built), rest, [marked, segs, sizes, open_, cutout]


def _digests(texts: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """(key, k2, a, b) of the repeated strings of texts, each by its digest, and tables to delete at last."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, k2, off, n, data in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                at = range(len(data) - length + 1)
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(data[i : i + length]) for i in at]), pa.array([k] * len(at)), pa.array([k2] * len(at), pa.int32()), pa.array([off + i for i in at]), pa.array([n] * len(at))], ["s", "key", "k2", "a", "n"])

    every = spill(texts.select("key", "k2", "off", "n", "data").mapInArrow(strings, "s binary, key long, k2 int, a long, n long"), "sub-strings")
    often = spill(every.groupBy("s").agg(F.sum("n").alias("c")).filter("c > 1").select("s"), "sub-often")
    return every.filter("n = 1").join(often.hint("merge"), "s").select("key", "k2", "a", F.col("a").alias("b")), [every, often]


def dedup_substrings(docs: DataFrame, keep: list[str] | None = None, length: int = LENGTH, gram: int = GRAM, wide: int = WIDE, with_text: bool = False) -> DataFrame:
    """Remove every byte that lies in a string of `length` bytes found more than once: (keep..., n_bytes, n_removed, n_spans, kept_sha256[, kept]).

    Strings are of one text's UTF-8 bytes, judged on the input; overlapping occurrences count, within a text or across. A null text has
    no bytes. A row that repeats doc_id and text is one more occurrence. Texts shorter than `length` stay whole. An empty table
    gives an empty result. kept: the remaining bytes, which can cut characters. Texts of any length are read whole, one at a time; columns but
    doc_id, text and those in keep are not read, and keep can't hold names of the result.

    An anchor that more than `wide` different segments have is divided: its segments are texts again, with anchors of longer grams, so that
    fewer share one; twice, if need be. Only strings that are still in wide groups then, equal in all but a twentieth of their possible
    bytes with very many others, are told apart by digests.
    """
    keep = list(keep or ["doc_id"])
    # 96 bits stand for a row's id and text
    key, check = F.xxhash64("doc_id", "text"), F.hash(F.lit(7), "text", "doc_id")
    whole = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    texts = docs.select(key.alias("key"), check.alias("k2"), F.lit(0).cast("long").alias("off"), F.lit(1).cast("long").alias("n"), whole.alias("data"))
    rest, used = texts, []
    starts = None
    for g in (gram, length - (length - gram) // 3, length - (length - gram) // 14):
        found, rest, tables = _level(rest, length, g, wide)
        starts = found if starts is None else starts.unionByName(found)
        used += tables
        if rest.isEmpty():
            break
    else:
        found, tables = _digests(rest, length)
        starts = starts.unionByName(found)
        used += tables
    starts = spill(starts.groupBy("key", "k2").agg(F.collect_set(F.struct("a", "b")).alias("starts")), "sub-starts")  # of one document
    drop_spilled(*used)
    names = [c for c in keep if c != "text"]
    joined = docs.select(*names, key.alias("__key"), check.alias("__k2"), whole.alias("__data")).join(starts.withColumnsRenamed({"key": "__key", "k2": "__k2"}).hint("merge"), ["__key", "__k2"], "left").select(*names, "__data", "starts")
    k = len(names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for data, s in zip(b.column(k).to_pylist(), b.column(k + 1).to_pylist(), strict=True):
                removed, runs, left = cut(data, [(x["a"], x["b"]) for x in s or ()], length)
                for c, x in zip(out, (len(data), removed, runs, hashlib.sha256(left).hexdigest(), left), strict=True):
                    c.append(x)
            cols = [pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.string(), pa.binary()], strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:k], *cols[: 4 + with_text]], [*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: k + 4 + with_text])

    head = "".join(f"`{c}` {joined.schema[c].dataType.simpleString()}, " for c in names)
    return joined.mapInArrow(finish, f"{head}n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)

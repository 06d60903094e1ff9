"""Hard-negative mining: integer products of bit-sliced vectors, most significant planes first, with intervals that close in on each score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_spilled, spill

#: Rows of one side of a comparison; more anchors or more rows are further blocks. At least so many blocks of rows, to use all executors on small input too.
ANCHORS, ROWS, LEAST = 8192, 16_384, 24
#: Anchors and rows of a tile inside a block: what is held for all pairs at once.
TILE = 256, 4096
#: Share of a tile's pairs under which planes are read for the remaining pairs alone; those are taken so many at a time.
SPARSE, CHUNK = 1 / 16, 50_000
#: Rows with a squared norm from here on take no part: their scores need not fit 64 bits. Up to SMALL all sums here are exact in 64 bits, beyond it Python's own integers do.
LARGEST, SMALL = 2.0**62, 2.0**40


def quantised(vector: Column, scale: int = 256) -> Column:
    """Components x as floor(scale * x) in 32 bits, x as double."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(F.when(F.abs(x) < 2.0**23, x * scale).otherwise(F.lit(0.0))).cast("int"))


class Selection:
    """The best rows of each anchor in each of its windows of scores, gathered tile by tile; windows are [low, high], the best `k` have the highest scores, ties the smallest ids."""

    def __init__(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.a, self.low, self.high, self.k = anchors, low, high, k
        self.best = np.repeat(low[:, :, None] - 1, k, 2)  # scores of the best so far, ascending
        # to add in float: an interval's half width is a product of norms, with one to spare for rounding
        self.norm = np.sqrt((anchors.astype(np.float64) ** 2).sum(1)) if anchors.dtype != object else None
        self.found: list[tuple[np.ndarray, ...]] = []  # anchor, window, row, score

    def _times(self, rows: slice, plane: np.ndarray) -> np.ndarray:
        if self.a.dtype == object:
            return self.a[rows] @ plane.T.astype(np.int64).astype(object)
        return (self.a[rows].astype(np.float64) @ plane.T.astype(np.float64)).astype(np.int64)  # exact: sums are far under 2**53

    def _bounds(self, at, partial, left: int, rest: np.ndarray | None):
        """Interval of each score when `left` bits of the rows' components are open. at: anchors of partial; rest: norms of what is open around its middle."""
        open_ = (1 << left) - 1
        a = self.a[at]
        down, up = (np.minimum(a, 0).sum(1) * open_, np.maximum(a, 0).sum(1) * open_)
        if partial.ndim == 2:
            down, up = down[:, None], up[:, None]
        low, high = partial + down, partial + up
        if self.norm is not None and rest is not None:
            mid = a.sum(1) * (open_ / 2)
            half = self.norm[at, None] * rest + 1 if partial.ndim == 2 else self.norm[at] * rest + 1
            mid = mid[:, None] if partial.ndim == 2 else mid
            low = np.maximum(low, partial + np.floor(mid - half).astype(np.int64))
            high = np.minimum(high, partial + np.ceil(mid + half).astype(np.int64))
        return low, high

    def _live(self, at, low, high) -> np.ndarray:
        """Pairs whose interval reaches a window of their anchor at or above its k-th best score."""
        out = np.zeros(low.shape, bool)
        for w in range(self.low.shape[1]):
            least, most = np.maximum(self.low[at, w], self.best[at, w, 0]), self.high[at, w]
            if low.ndim == 2:
                least, most = least[:, None], most[:, None]
            out |= (high >= least) & (low <= most)
        return out

    def add(self, rows: np.ndarray, ids: np.ndarray, index: np.ndarray, allowed) -> None:
        """Rows (components, ids in the order of ties, their numbers); allowed(anchors, rows) masks pairs."""
        bits = int(max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))) - 1)).bit_length()
        low_bits = rows & ((1 << bits) - 1) if self.a.dtype != object else np.array([[int(x) & ((1 << bits) - 1) for x in r] for r in rows], object).reshape(rows.shape)
        plane = lambda b: ((low_bits >> b) & 1).astype(np.float64)
        def rest(b):
            if self.norm is None:
                return None
            return np.sqrt((((low_bits & ((1 << b) - 1)) - ((1 << b) - 1) / 2) ** 2).sum(1))

        for start in range(0, len(self.a), TILE[0]):
            at = slice(start, start + TILE[0])
            mask = allowed(at)
            if not mask.any():
                continue
            partial = -(1 << bits) * self._times(at, (rows < 0).astype(np.float64))
            left = bits
            while left and mask.sum() > SPARSE * mask.size:
                left -= 1
                partial = partial + (1 << left) * self._times(at, plane(left))
                mask &= self._live(at, *self._bounds(at, partial, left, rest(left)))
            i, j = np.nonzero(mask)
            partial, i = partial[i, j], i + start
            while left and len(i):
                left -= 1
                bit = plane(left).astype(np.int64).astype(self.a.dtype)
                partial = partial + np.concatenate([(self.a[i[c : c + CHUNK]] * bit[j[c : c + CHUNK]]).sum(1) for c in range(0, len(i), CHUNK)]) * (1 << left)
                q = rest(left)
                low, high = self._bounds(i, partial, left, None if q is None else q[j])
                self._raise(i, low, high)
                keep = self._live(i, low, high)
                i, j, partial = i[keep], j[keep], partial[keep]
            self._take(i, index[j], ids[j], partial)

    def _raise(self, i, low, high) -> None:
        """Pairs that are surely in a window lift its k-th best score to the k-th of their lower ends."""
        for w in range(self.low.shape[1]):
            sure = (low >= self.low[i, w]) & (high <= self.high[i, w])
            a, s = i[sure], low[sure].astype(np.int64)
            o = np.lexsort((-s, a))
            a, s = a[o], s[o]
            new = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, int)
            nth = np.arange(len(a)) - np.repeat(new, np.diff(np.r_[new, len(a)]))
            last = nth == self.k - 1
            self.best[a[last], w, 0] = np.maximum(self.best[a[last], w, 0], s[last])

    def _take(self, i, number, ids, score) -> None:
        for w in range(self.low.shape[1]):
            inside = (score >= np.maximum(self.low[i, w], self.best[i, w, 0])) & (score <= self.high[i, w])
            self.found.append((i[inside], np.full(int(inside.sum()), w), number[inside], score[inside].astype(np.int64), ids[inside]))
        self.found = [self._reduced()]
        a, w, _, s, _ = self.found[0]
        if not len(a):
            return
        # k-th best of each anchor and window that has k
        key = a * self.low.shape[1] + w
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.diff(np.r_[new, len(key)])
        full = new[n == self.k] + self.k - 1
        self.best[a[full], w[full], 0] = np.maximum(self.best[a[full], w[full], 0], s[full])

    def _reduced(self) -> tuple[np.ndarray, ...]:
        a, w, n, s, t = (np.concatenate(x) for x in zip(*self.found, strict=True))
        o = np.lexsort((n, t, -s, w, a))
        a, w, n, s, t = a[o], w[o], n[o], s[o], t[o]
        key = a * self.low.shape[1] + w
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(a) else np.zeros(0, int)
        keep = np.arange(len(a)) - np.repeat(new, np.diff(np.r_[new, len(a)])) < self.k
        return a[keep], w[keep], n[keep], s[keep], t[keep]

    def result(self) -> tuple[np.ndarray, ...]:
        """(anchor, window, row, score) of the best, and ids."""
        return self._reduced() if self.found else tuple(np.zeros(0, np.int64) for _ in range(5))


def _components(col: pa.ChunkedArray, pick: np.ndarray, dim: int, wide: bool) -> np.ndarray:
    x = col.take(pa.array(pick)).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(pick), dim)
    return x.astype(object) if wide else x


def _pairs(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, compare, schema: str) -> DataFrame:
    """Every block of anchors with every block of rows, each pair of blocks once."""
    na, nr = -(-n_anchors // ANCHORS) or 1, max(LEAST, -(-n_rows // ROWS))
    block = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "rid"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("a", block(na, 3)).withColumn("b", each(nr))
    right = rows.withColumn("b", block(nr, 4)).withColumn("a", each(na))
    right = right.select(*[F.col(c).alias(f"row_{c}") for c in right.columns])  # of columns that both sides share, a cogroup passes one
    return left.groupBy("a", "b").cogroup(right.groupBy("row_a", "row_b")).applyInArrow(compare, schema)


def _comparison(k: int, same: bool, share: tuple[int, int] | None):
    """A function for two blocks: k best rows of the anchor's own label without itself (same), or of other labels in the windows that the anchor's positives give."""
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int32() if c == "place" else pa.int64()) for c in ("anchor", "place", "rid", "vec_id", "score")})
        right = right.rename_columns([c.removeprefix("row_") for c in right.column_names])
        labels = pa.chunked_array([*left.column("label").chunks, *right.column("label").chunks], left.schema.field("label").type).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        la, lr = labels[: left.num_rows], labels[left.num_rows :]
        a_rid, r_rid, r_id = left.column("rid").to_numpy(), right.column("rid").to_numpy(), right.column("vec_id").to_numpy()
        da, dr = (t.column("dims").to_numpy() for t in (left, right))
        wide = max(t.column("norm").to_numpy().max(initial=0) for t in (left, right)) > SMALL
        kind = object if wide else np.int64
        out: list[list[np.ndarray]] = []
        # positives only meet rows of their own label, so each label is a comparison of its own
        cases = [(d, lab) for d in np.unique(da) for lab in (np.unique(la[da == d]) if same else [None])]
        for d, lab in cases:
            mine = np.flatnonzero((da == d) & ((la == lab) if same else True))
            theirs = np.flatnonzero((dr == d) & ((lr == lab) if same else True))
            if not len(theirs):
                continue
            a = _components(left.column("c"), mine, int(d), wide)
            if share is None:
                low = np.full((len(mine), 1), -(1 << 62), kind)
                high = np.full((len(mine), 1), 1 << 62, kind)
            else:
                p = left.column("positive_scores").take(pa.array(mine)).to_pylist()
                w = max(map(len, p))
                low = np.array([[-(-share[0] * s // 100) for s in x] + [1] * (w - len(x)) for x in p], kind).reshape(len(mine), w)
                high = np.array([[share[1] * s // 100 for s in x] + [0] * (w - len(x)) for x in p], kind).reshape(len(mine), w)
            best = Selection(a, low, high, k)
            for at in range(0, len(theirs), TILE[1]):
                part = theirs[at : at + TILE[1]]
                allowed = (lambda s: a_rid[mine[s], None] != r_rid[part][None]) if same else (lambda s: la[mine[s], None] != lr[part][None])  # noqa: B023
                best.add(_components(right.column("c"), part, int(d), wide), r_id[part], part, allowed)
            i, w, j, s, _ = best.result()
            out.append([mine[i], w, j, s])
        i, w, j, s = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4
        cols = {"anchor": a_rid[i], "place": w.astype(np.int32), "rid": r_rid[j], "vec_id": r_id[j], "score": s.astype(np.int64)}
        return pa.table(cols)

    return compare


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, share: tuple[int, int] = (30, 90)) -> DataFrame:
    """Hard negatives: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score). vectors: vec_id, label, embedding; anchors: a condition on them.

    Components become floor(256 * x); a score is the integer inner product with the anchor. An anchor's positives are the first `positives` other rows of
    its label, by score, ties by smaller vec_id; for each the first `negatives` rows of other labels are returned whose score lies between share[0] and
    share[1] percent of the positive's. All rows are compared with all anchors, in blocks; what a block returns is bounded by its anchors.

    Components' bit planes are read from the most significant one on. Each plane halves the interval in which a score can lie; a pair whose interval can't
    reach a window, or the k-th best score known in it, is dropped, and further planes are read for the others only.

    Rows without a label or a vector, or with null or non-finite components, take no part; nor do rows without a vec_id, which can't be named, and vectors of a squared
    integer norm of 2**62 or more, whose scores need not fit 64 bits. Vectors meet those of their own length only. Rows that repeat are rows of their own: a copy of an anchor
    is an anchor, and a positive of it. A positive with a negative score has no negatives, one with score zero those with score zero. An anchor alone in its label gives
    no row; an empty table gives none. Other columns aren't read. A hot label or vector is no group: blocks are dealt by row.
    """
    x = F.col("embedding").cast("array<double>")
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    norm = F.aggregate(x, F.lit(0.0), lambda s, v: s + (v * 256) * (v * 256))
    src = vectors.select("vec_id", "label", "embedding", anchors.alias("is_anchor")).filter(F.coalesce(sound, F.lit(False)) & (norm < LARGEST * 0.999))
    src = src.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), "label", F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"), quantised(F.col("embedding")).alias("c"), F.size("embedding").alias("dims"))
    whole = F.aggregate(F.col("c"), F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    src = spill(src.withColumn("norm", whole), "hard-vectors")
    rows, own = src.drop("is_anchor"), src.filter("is_anchor").drop("is_anchor")
    n_rows, n_anchors = src.agg(F.count("*"), F.sum(F.col("is_anchor").cast("long"))).first()
    schema = "anchor long, place int, rid long, vec_id long, score long"
    order = [F.desc("score"), F.asc("vec_id"), F.asc("rid")]
    near = _pairs(own, rows, n_anchors or 0, n_rows, _comparison(positives, True, None), schema)
    near = near.withColumn("nth", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter(F.col("nth") <= positives)
    lists = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("p"))
    lists = lists.select(F.col("anchor").alias("rid"), F.col("p.vec_id").alias("positive_ids"), F.col("p.score").alias("positive_scores"))
    asked = spill(own.join(lists, "rid"), "hard-anchors", tidy=False)
    hard = _pairs(asked.drop("positive_ids", "vec_id"), rows, n_anchors or 0, n_rows, _comparison(negatives, False, share), schema)
    hard = hard.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*order))).filter(F.col("rank") <= negatives)
    hard = hard.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).drop("rid")
    named = asked.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"), "positive_ids", "positive_scores")
    at = lambda c: F.get(c, F.col("place"))
    out = hard.join(named, "anchor").select("anchor_id", at("positive_ids").alias("positive_id"), "rank", "negative_id", at("positive_scores").alias("positive_score"), "negative_score")
    out = spill(out, "hard-negatives", tidy=False)
    drop_spilled(src, asked)
    return out

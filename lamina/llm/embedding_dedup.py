"""Embedding near-dedup: an inverted multi-index whose cells are visited nearest first, and exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, components, spill, union_find

#: The codebooks are fitted, and the number of visits chosen, on at most this many vectors; all vectors are indexed.
SAMPLE = 10_000
#: Vectors for each cell of the grid, about, and the least and most words of a codebook.
PER_CELL, CODES = 64, (6, 2048)
#: Share of links, at exactly the threshold's cosine, whose cells must be visited from one end or the other.
TARGET_RECALL = 0.99
#: Vectors of one side of a comparison; larger groups are compared block by block.
BLOCK = 4096
BUCKET = 40_000


def _apart(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances. einsum: threaded linear algebra can hang in a driver that has forked the JVM."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * np.einsum("nd,kd->nk", x, codes) + (codes * codes).sum(1), 0)


def codebook(x: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """k-means centres of the rows of x."""
    rng = np.random.default_rng(seed)
    codes = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = _apart(x, codes).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], 1)
        codes[n > 0] = sums[n > 0] / n[n > 0, None]
    return codes


class MultiIndex:
    """Two codebooks, one for each half of the vectors; cell i * k + j holds the vectors nearest to word i and word j."""

    def __init__(self, sample: np.ndarray, k: int, cosine: float, target: float = TARGET_RECALL, seed: int = 5):
        half = sample.shape[1] // 2
        self.k, self.half = k, half
        self.books = codebook(sample[:, :half], k, seed), codebook(sample[:, half:], k, seed + 1)
        # visits: neighbours of sampled vectors at exactly the threshold, in random directions, are the hardest to find
        rng = np.random.default_rng(seed)
        x = sample[rng.choice(len(sample), min(2000, len(sample)), replace=False)]
        away = rng.normal(size=x.shape)
        away -= (away * x).sum(1, keepdims=True) * x
        away /= np.maximum(np.sqrt((away * away).sum(1, keepdims=True)), 1e-12)
        y = cosine * x + np.sqrt(1 - cosine * cosine) * away
        ranks = np.minimum(self._rank(x, y), self._rank(y, x))
        self.visits = int(np.quantile(ranks, target)) + 1

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _apart(x[:, : self.half], self.books[0]), _apart(x[:, self.half :], self.books[1])

    def _rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many cells are nearer to x than the one that holds y."""
        out = np.empty(len(x), np.int64)
        for at in range(0, len(x), 200):
            part = slice(at, at + 200)
            d1, d2 = self.halves(x[part])
            e1, e2 = self.halves(y[part])
            rows = np.arange(len(d1))
            goal = d1[rows, e1.argmin(1)] + d2[rows, e2.argmin(1)]
            s = np.sort(d2, 1)
            out[part] = [sum(np.searchsorted(s[r], goal[r] - d1[r], side="left")) for r in rows]
        return out

    def traverse(self, x: np.ndarray) -> np.ndarray:
        """The `visits` nearest cells of each vector, nearest first, by the multi-sequence algorithm (Babenko and Lempitsky 2012)."""
        d1, d2 = self.halves(x)
        o1, o2 = np.argsort(d1, 1, kind="stable"), np.argsort(d2, 1, kind="stable")
        n = min(self.visits, self.k * self.k)
        out = np.empty((len(x), n), np.int64)
        for r in range(len(x)):
            a, b = d1[r, o1[r]].tolist(), d2[r, o2[r]].tolist()
            # a pair enters the queue when the pairs before it in both sequences have left
            heap, done = [(a[0] + b[0], 0, 0)], [0] * self.k
            for v in range(n):
                _, i, j = heappop(heap)
                out[r, v] = o1[r, i] * self.k + o2[r, j]
                done[i] = j + 1
                if i + 1 < self.k and done[i + 1] == j:
                    heappush(heap, (a[i + 1] + b[j], i + 1, j))
                if j + 1 < self.k and (i == 0 or done[i - 1] > j + 1):
                    heappush(heap, (a[i] + b[j + 1], i, j + 1))
        return out


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of dim numbers as doubles scaled to length 1."""
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def link_vectors(rows: DataFrame, index: MultiIndex, dim: int, cosine: float, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """Counts and edges between rows (rid, label, embedding): (u, v, n); v null: u has n more links; else an edge of a spanning forest.

    A vector rests in its own cell and calls at each cell it visits. All cells with one first word, of one label, are
    a group; a vector goes to a group once, with the list of cells. Groups of over `block` residents
    or callers are cut into pieces, each side of a piece bounded. A link that both ends find counts in the smaller
    cell; so no pair leaves a task, only sums and forests.
    """
    k = index.k

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rid", "label", "embedding", "own", "visits", "i", "home"]
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                cells = index.traverse(_matrix(b.column(2), dim))
                first = cells // k
                r, i = np.nonzero(np.stack([(first == w).any(1) for w in range(k)], 1))
                lists = pa.array([c for c in cells.astype(np.int32)], pa.list_(pa.int32()))
                own = cells[:, 0]
                for home in (True, False):
                    rr, ii = (np.arange(len(own)), own // k) if home else (r, i)
                    t = pa.array(rr)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(t), b.column(1).take(t), b.column(2).take(t), pa.array(own[rr]), lists.take(t), pa.array(ii.astype(np.int32)), pa.array(np.full(len(rr), home))], names)

    schema = f"rid long, label {rows.schema['label'].dataType.simpleString()}, embedding {rows.schema['embedding'].dataType.simpleString()}, own long, visits array<int>, i int, home boolean"
    placed = spill(rows.select("rid", "label", "embedding").mapInArrow(place, schema), "emb-placed")
    size = placed.groupBy("label", "i").agg(F.sum(F.col("home").cast("long")).alias("r"), F.sum((~F.col("home")).cast("long")).alias("c"))
    size = size.select("label", "i", F.ceil(F.greatest("r", F.lit(1)) / block).cast("int").alias("nr"), F.ceil(F.greatest("c", F.lit(1)) / block).cast("int").alias("nc"))
    size = spill(size, "emb-sizes")
    total = placed.count()
    n = buckets_for(total, bucket)
    mine = F.pmod(F.xxhash64(F.lit(9), "rid"), F.when(F.col("home"), F.col("nr")).otherwise(F.col("nc"))).cast("int")
    dealt = placed.join(size, ["label", "i"]).withColumn("mine", mine)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("nc")).otherwise(F.col("nr")) - 1)))
    dealt = dealt.select("rid", "label", "embedding", "own", "visits", "i", "home", F.when(F.col("home"), F.col("mine")).otherwise(F.col("other")).alias("a"), F.when(F.col("home"), F.col("other")).otherwise(F.col("mine")).alias("b"))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("label", "i", "a", "b"), F.lit(n)).cast("int"))

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        rid, label, own, i, a, b = (t.column(c).to_numpy() for c in ("rid", "label", "own", "i", "a", "b"))
        home = t.column("home").to_numpy(zero_copy_only=False)
        x = _matrix(t.column("embedding").chunk(0) if t.num_rows else pa.array([], pa.list_(pa.float64())), dim)
        visits = t.column("visits").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        values, ident = np.unique(rid, return_inverse=True)
        links, root_a, root_b = np.zeros(len(values), np.int64), [], []
        order = np.lexsort((b, a, i, label))
        keys = np.stack([label[order], i[order], a[order], b[order]], 1)
        cuts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1), [True])))
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            part = order[lo:hi]
            rest, call = part[home[part]], part[~home[part]]
            if not len(rest) or not len(call):
                continue
            rest = rest[np.argsort(own[rest], kind="stable")]
            cells, starts = np.unique(own[rest], return_index=True)
            ends = np.append(starts[1:], len(rest))
            for cell, s, e in zip(cells, starts, ends, strict=True):
                y, who = rest[s:e], call[(visits[call] == cell).any(1)]
                for at in range(0, len(who), 1024):
                    w = who[at : at + 1024]
                    p, q = np.nonzero(x[w] @ x[y].T >= cosine)
                    p, q = w[p], y[q]
                    same = own[p] == cell
                    # within the cell each pair is met twice; across cells, skip if the other end meets it in a smaller cell
                    keep = np.where(same, rid[p] < rid[q], True)
                    cross = np.flatnonzero(~same & (own[p] < cell))
                    for z in range(0, len(cross), 100_000):
                        c = cross[z : z + 100_000]
                        keep[c] = ~(visits[q[c]] == own[p[c]][:, None]).any(1)
                    p, q = ident[p[keep]], ident[q[keep]]
                    links += np.bincount(p, minlength=len(values)) + np.bincount(q, minlength=len(values))
                    if len(p):
                        # a forest of this block is enough
                        used, inv = np.unique(np.concatenate([p, q]), return_inverse=True)
                        root = union_find(len(used), inv[: len(p)], inv[len(p) :])
                        tied = np.flatnonzero(root != np.arange(len(used)))
                        root_a.append(used[tied])
                        root_b.append(used[root[tied]])
        pa_, pb = np.concatenate(root_a or [np.zeros(0, np.int64)]), np.concatenate(root_b or [np.zeros(0, np.int64)])
        root = union_find(len(values), pa_, pb)
        tied, some = np.flatnonzero(root != np.arange(len(values))), np.flatnonzero(links)
        u = np.concatenate([values[tied], values[some]])
        v = pa.array(np.concatenate([values[root[tied]], np.zeros(len(some), np.int64)]), mask=np.arange(len(u)) >= len(tied))
        return pa.table({"u": u, "v": v, "n": np.concatenate([np.zeros(len(tied), np.int64), links[some]])})

    return dealt.groupBy("bucket").applyInArrow(compare, "u long, v long, n long")


def link_exactly(rows: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """link_vectors() for vectors of odd lengths: all of one label and length, in pairs of blocks of bounded size. rows also has dims."""
    sizes = rows.groupBy("label", "dims").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = rows.join(spill(sizes, "emb-odd", tidy=False), ["label", "dims"]).withColumn("mine", F.pmod(F.xxhash64(F.lit(9), "rid"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = placed.select("rid", "label", "dims", "embedding", "mine", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"))

    def compare(t: pa.Table) -> pa.Table:
        rid, mine, a, b, dims = (t.column(c).to_numpy() for c in ("rid", "mine", "a", "b", "dims"))
        x = _matrix(t.column("embedding").combine_chunks(), int(dims[0]))
        one, two = np.flatnonzero(mine == a), np.flatnonzero(mine == b)
        links, us, vs = np.zeros(len(rid), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(one), 1024):
            p, q = np.nonzero(x[one[at : at + 1024]] @ x[two].T >= cosine)
            p, q = one[at : at + 1024][p], two[q]
            keep = rid[p] < rid[q] if a[0] == b[0] else np.ones(len(p), bool)
            p, q = p[keep], q[keep]
            links += np.bincount(p, minlength=len(rid)) + np.bincount(q, minlength=len(rid))
            us.append(p)
            vs.append(q)
        order = np.argsort(rid)  # roots are the smallest rows
        rank = np.empty(len(rid), np.int64)
        rank[order] = np.arange(len(rid))
        root = union_find(len(rid), rank[np.concatenate(us)], rank[np.concatenate(vs)])
        tied, some = np.flatnonzero(root != np.arange(len(rid))), np.flatnonzero(links)
        u = np.concatenate([rid[order][tied], rid[some]])
        v = pa.array(np.concatenate([rid[order][root[tied]], np.zeros(len(some), np.int64)]), mask=np.arange(len(u)) >= len(tied))
        return pa.table({"u": u, "v": v, "n": np.concatenate([np.zeros(len(tied), np.int64), links[some]])})

    return dealt.groupBy("label", "dims", "a", "b").applyInArrow(compare, "u long, v long, n long")


def _indexed(good: DataFrame, dim: int, n: int, cosine: float) -> DataFrame:
    sample = good.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    k = int(min(max((n / PER_CELL) ** 0.5, CODES[0]), CODES[1]))
    return link_vectors(good, MultiIndex(_matrix(sample, dim), k, cosine), dim, cosine)


def near_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """Near-duplicate vectors of equal label: (vec_id, n_links, component_id, kept), one row per row.

    Links are pairs with cosine >= `cosine` in double precision; those that the index finds, about 99 % or more (the target
    holds for links at the threshold, the hardest). The index is of the most frequent length; vectors of other lengths are compared with
    those of their own, exactly and in blocks. Vectors that are null, zero, hold null or non-finite components, or have no label link with nothing. Rows that repeat are
    vectors of their own. Other columns are not read. component_id is the smallest vec_id reachable, kept where that is the row's own. An
    empty table gives an empty result. The driver holds a sample of at most SAMPLE vectors and the two codebooks.
    """
    src = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).withColumn("rid", F.monotonically_increasing_id())
    sound = F.exists("embedding", lambda v: v != 0) & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    src = spill(src.withColumn("sound", F.coalesce(F.col("label").isNotNull() & sound, F.lit(False))), "emb-rows")
    lengths = src.filter("sound").groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    every = src.select("rid", "vec_id")
    if lengths is None:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dim, n = lengths["d"], lengths["count"]
    odd = src.filter("sound").withColumn("dims", F.size("embedding")).filter((F.col("dims") != dim) | (F.col("dims") < 2))
    found = link_exactly(odd, cosine)
    if dim > 1:
        found = found.unionByName(_indexed(src.filter("sound").filter(F.size("embedding") == dim), dim, n, cosine))
    found = spill(found, "emb-links")
    links = found.filter("v is null").groupBy("u").agg(F.sum("n").alias("n_links"))
    cc = components(found.filter("v is not null").select("u", "v"))
    named = every.join(cc, every["rid"] == cc["id"], "left").select("rid", "vec_id", F.coalesce("component", "rid").alias("c"))
    named = spill(named, "emb-cc")
    least = spill(named.groupBy("c").agg(F.min("vec_id").alias("component_id")), "emb-least")
    out = named.join(least, "c").join(links, F.col("rid") == links["u"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id")
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

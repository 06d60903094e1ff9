"""SimHash near-duplicates: segment popcounts on a grid, Manhattan distance as a lower bound, exact check."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, components, drop_spilled, spill, union_find

SEED = 42
#: Bits of a segment. A fingerprint is a point with one coordinate, the number of 1 bits, for each segment.
SEGMENT = 2
#: Fingerprints of a cell that are compared with one another at once; larger cells are compared block by block.
BLOCK = 4096
#: Points that one task's bucket of cells holds, about.
BUCKET = 60_000
#: What a point's key costs, moved and sorted, in comparisons of two points.
KEY_COST = 1000
#: Min-hashes of a text's set of shingles: BANDS cells of ROWS values each. Two sets with similarity 0.8 share a cell with
#: probability 0.8**3 in each band, so a pair is missed in all 20 once in 2 * 10**6; sets that share little hardly ever meet.
BANDS, ROWS = 20, 3
#: Sets up to SMALL shingles have min-hashes under as many functions; sets from LARGE on have the least hash of each of as many parts of
#: the range, which takes a sorted set no time. Similar sets are both of one kind at least, as 4/5 of SMALL is LARGE.
SMALL, LARGE = 160, 128
#: Bits that the fingerprints of two similar texts may differ in. At similarity 0.8 the mean is about 10, the deviation 3. Sets of fewer
#: than FEW shingles are compared without this bound, as theirs spread more.
FAR, FEW = 24, 16
#: Texts, and shingle hashes, that one side of a comparison holds at most, about, and hashes of a task's bucket.
SIDE, SIDE_HASHES, BUCKET_HASHES = 1024, 300_000, 2_000_000
_rng = np.random.default_rng(SEED)
_FACTORS, _OFFSETS = (_rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_EDGES = np.array([(i << 64) // (BANDS * ROWS) for i in range(BANDS * ROWS)], np.uint64)
#: Where a part without a hash looks for one: the same order for all sets.
_ELSEWHERE = np.stack([_rng.permutation(BANDS * ROWS) for _ in range(BANDS * ROWS)])


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of a whole text, with repeats: A-Z lower-cased, words between [\\x20\\x09-\\x0D].

    Fewer words than a shingle: the whole sequence is the one shingle; no word: none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.diff(ends, prepend=0)).tolist()
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=False)], np.uint64)


def majority(h: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes; none: zero."""
    n = len(h)
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = h[at : at + 65536]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * bits > n).tolist())


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit fingerprint of a whole text: a bit is 1 if it is set in over half of the shingles' hashes."""
    return majority(shingle_hashes(text, shingle))


def with_fingerprint(docs: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., fp): fp is the fingerprint's 64 bits as a long; one narrow pass."""
    src = docs.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column(len(keep)).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(fp)], [*keep, "fp"])

    head = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(run, f"{head}, fp long")


def unary(fp: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Each segment's popcount in unary, as low bits of the segment: Manhattan distance of popcounts is the Hamming distance of these words."""
    bits = np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = bits.reshape(len(fp), 64 // segment, segment).sum(2)
    out = (np.arange(segment) < counts[:, :, None]).astype(np.uint8).reshape(len(fp), 64)
    return np.packbits(out, axis=1, bitorder="little").view("<u8").ravel()


def cell_masks(distance: int, groups: int, segment: int = SEGMENT) -> list[int]:
    """The segments are cut into `groups`; a bit mask for each choice of groups - distance of them.

    Points within that Manhattan distance differ in `distance` groups at most, so they agree on all coordinates of one choice at least.
    """
    n = 64 // segment
    cuts = [n * g // groups for g in range(groups + 1)]
    each = [((1 << (b - a) * segment) - 1) << a * segment for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(each, groups - distance)]


def groups_for(points: int, distance: int, segment: int = SEGMENT) -> int:
    """Into how many groups the segments of so many points are best cut.

    More groups make more keys for a point, of more coordinates each, so that fewer points that are far apart share a cell. Of two
    unrelated points a segment's popcounts are equal with probability `alike`, and all of a choice with a power of that. Pairs grow
    with the square of the points and keys don't; so the best number grows with the points, and pairs for a
    point stay within a small factor of its keys.
    """
    alike = sum(comb(segment, k) ** 2 for k in range(segment + 1)) / 4**segment

    def cost(groups: int) -> float:
        keys, shared = comb(groups, distance), alike ** (64 / segment * (groups - distance) / groups)
        return keys * KEY_COST + keys * points * shared / 2

    return min(range(distance + 1, 64 // segment + 1), key=cost)


def _links(x: np.ndarray, y: np.ndarray, ux: np.ndarray, uy: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints within the distance: the lower bound first, then the exact count on what is left."""
    out_a, out_b = [], []
    step = max(1, 2_000_000 // max(1, len(y)))
    for at in range(0, len(x), step):
        a, b = np.nonzero(np.bitwise_count(ux[at : at + step, None] ^ uy[None, :]) <= distance)
        a += at
        exact = np.bitwise_count(x[a] ^ y[b]) <= distance
        out_a.append(a[exact])
        out_b.append(b[exact])
    return np.concatenate(out_a or [np.zeros(0, np.int64)]), np.concatenate(out_b or [np.zeros(0, np.int64)])


def link_fingerprints(points: DataFrame, distance: int = 4, block: int = BLOCK, bucket: int = BUCKET, groups: int | None = None) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (fp, id), u and v their ids, whose components are those of all links.

    Grid range-join: a point falls into one cell for each choice of groups of coordinates, and any two points within
    the distance share a cell; the number of groups follows the number of points (groups_for()). Cells are dealt to tasks by hash; one of more than `block` points is cut into
    blocks and each pair of blocks is a cell of its own, so a cell of any size is compared whole, in
    bounded pieces. Each piece returns a spanning forest of its links, not the pairs.
    """
    masks = cell_masks(distance, groups or groups_for(points.count(), distance))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            u = unary(fp.view(np.uint64))
            for g, m in enumerate(masks):
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.full(len(fp), g, np.int32)), pa.array((u & np.uint64(m)).view(np.int64))], ["fp", "id", "g", "cell"])

    placed = points.select("fp", "id").mapInArrow(cells, "fp long, id long, g int, cell long")
    sizes = spill(placed.groupBy("g", "cell").agg(F.count("*").alias("n")).filter("n > 1"), "sim-cells")
    rows = sizes.agg(F.sum(F.col("n") * F.ceil(F.col("n") / block))).first()[0] or 0
    cut = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(3), "fp"), cut).cast("int")
    pieces = placed.join(sizes, ["g", "cell"]).select("fp", "id", "g", "cell", mine.alias("mine"), F.explode(F.sequence(F.lit(0), cut - 1)).alias("other"))
    pieces = pieces.select("fp", "id", "g", "cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") <= F.col("other")).alias("left"))
    n = buckets_for(rows, bucket)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("g", "cell", "i", "j"), F.lit(n)).cast("int"))

    def compare(t: pa.Table) -> pa.Table:
        fp, ids, g, cell, i, j, left = (t.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "id", "g", "cell", "i", "j", "left"))
        order = np.lexsort((j, i, cell, g))
        keys = np.stack([g[order], cell[order], i[order], j[order]], 1)
        cuts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1), [True])))
        u = unary(fp.view(np.uint64))
        f = fp.view(np.uint64)
        us, vs = [], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            rows = order[a:b]
            one, two = (rows, rows) if i[rows[0]] == j[rows[0]] else (rows[left[rows]], rows[~left[rows]])
            x, y = _links(f[one], f[two], u[one], u[two], distance)
            us.append(one[x])
            vs.append(two[y])
        a, b = np.concatenate(us), np.concatenate(vs)
        # ids in ascending order, so that the forest's roots are the smallest ids
        values, rank = np.unique(ids, return_inverse=True)
        root = union_find(len(values), rank[a], rank[b])
        tied = np.flatnonzero(root != np.arange(len(values)))
        return pa.table({"u": values[tied], "v": values[root[tied]]})

    return pieces.groupBy("bucket").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, keep: list[str] | None = None, distance: int = 4) -> DataFrame:
    """Near-duplicate groups: (keep..., fingerprint, component_id) for each row; component_id is the smallest doc_id reachable.

    Rows with equal fingerprints are one point, so groups of copies of any size cost one. Null and empty texts have the
    fingerprint zero and link like any other. A row without a doc_id has its group's component_id, null
    if no row of the group has an id; repeated rows are alike; an empty table gives an empty result. Whole texts of any length are
    read; of other columns those in keep pass, whatever their names but fp, fingerprint and component_id.
    """
    keep = list(keep or ["doc_id"])
    rows = spill(with_fingerprint(docs, keep), "sim-rows")
    points = spill(rows.groupBy("fp").agg(F.min("doc_id").alias("id")), "sim-points")
    # fingerprints stand for themselves in edges: ids may be null
    named = points.select("fp", F.col("fp").alias("id"))
    cc = components(link_fingerprints(named, distance))
    by_fp = points.join(cc, points["fp"] == cc["id"], "left").select("fp", points["id"].alias("id"), F.coalesce("component", "fp").alias("c"))
    by_fp = spill(by_fp, "sim-cc")
    least = by_fp.groupBy("c").agg(F.min("id").alias("component_id"))
    groups = spill(by_fp.join(least, "c").select("fp", "component_id"), "sim-groups")
    return rows.join(groups, "fp").select(*keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _small_min(hashes: np.ndarray) -> np.ndarray:
    """Least values of a set under each of the functions; of multiplied numbers the high half is random, so it is folded down."""
    x = hashes[:, None] * _FACTORS + _OFFSETS
    return ((x ^ (x >> np.uint64(32))) * _FACTORS[::-1]).min(0)


def _large_min(hashes: np.ndarray) -> np.ndarray:
    """Least hash in each part of the range, of a sorted set; an empty part takes that of another."""
    at = np.searchsorted(hashes, _EDGES)
    full = at < np.append(at[1:], len(hashes))
    low = hashes[np.minimum(at, len(hashes) - 1)]
    for i in np.flatnonzero(~full):
        low[i] = hashes[at[_ELSEWHERE[i][full[_ELSEWHERE[i]]][0]]]
    return low


def cells_of(hashes: np.ndarray) -> list[int]:
    """The cells of a sorted set, one in each band for each kind it is of: digests of ROWS least values."""
    kinds = [(0, _small_min)] * (0 < len(hashes) <= SMALL) + [(BANDS, _large_min)] * (len(hashes) >= LARGE)
    out = []
    for first, f in kinds:
        low = f(hashes)
        out += [xxhash.xxh3_64_intdigest(low[i * ROWS : (i + 1) * ROWS].tobytes(), first + i) - (1 << 63) for i in range(BANDS)]
    return out


def with_sketch(docs: DataFrame, keep: list[str], shingle: int) -> DataFrame:
    """(keep..., sid, n, cells, fp): 128 bits that stand for the set of shingle hashes, its size and its cells (none for a text without a word); the text's fingerprint."""
    src = docs.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, n, cells, fp = [], [], [], []
            for t in b.column(len(keep)).to_pylist():
                every = shingle_hashes(t, shingle)
                fp.append(majority(every))
                h = np.unique(every)
                sid.append(xxhash.xxh3_128_digest(h.tobytes()))
                n.append(len(h))
                cells.append(cells_of(h))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(sid, pa.binary()), pa.array(n, pa.int64()), pa.array(cells, pa.list_(pa.int64())), pa.array(np.array(fp, np.uint64).view(np.int64))], [*keep, "sid", "n", "cells", "fp"])

    head = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(run, f"{head}, sid binary, n long, cells array<long>, fp long")


def similar_pairs(sets: list[np.ndarray], fp: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets, one from each side, with Jaccard similarity 0.8 at least; equal sides: each pair once.

    The sum of differences of segments' popcounts bounds the fingerprints' distance from below; what that and the distance leave is
    compared exactly, by the products of the sets' rows over those shingles that at least two sets hold.
    """
    na, nb = (np.array([len(sets[i]) for i in side], np.int64) for side in (one, two))
    far = np.bitwise_count(unary(fp[one])[:, None] ^ unary(fp[two])) <= FAR
    far &= np.bitwise_count(fp[one][:, None] ^ fp[two]) <= FAR
    far |= np.minimum(na[:, None], nb) < FEW
    far &= 5 * np.minimum(na[:, None], nb) >= 4 * np.maximum(na[:, None], nb)
    if one is two:
        far = np.triu(far, 1)
    a, b = np.nonzero(far)
    if len(a) <= 16:
        both = np.array([len(np.intersect1d(sets[one[x]], sets[two[y]], assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)
    else:
        rows, cols = np.unique(a), np.unique(b)
        used = np.unique(np.concatenate([one[rows], two[cols]]))
        values, at, count = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
        shared = np.cumsum(count > 1) - 1
        live = count[at] > 1
        owner, at = owner[live], shared[at[live]]
        left, right = np.searchsorted(used, one[rows]), np.searchsorted(used, two[cols])
        product = np.zeros((len(rows), len(cols)), np.float32)  # whole numbers below 2**24: exact
        width = int((count > 1).sum())
        step = max(1, min(width, 4_000_000 // len(used)))
        for lo in range(0, width, step):
            part = (at >= lo) & (at < lo + step)
            m = np.zeros((len(used), step), np.float32)
            m[owner[part], at[part] - lo] = 1
            product += m[left] @ m[right].T
        both = product[np.searchsorted(rows, a), np.searchsorted(cols, b)].astype(np.int64)
    ok = 9 * both >= 4 * (na[a] + nb[b])
    return one[a[ok]], two[b[ok]]


def _links_of(pieces: DataFrame, shingle: int) -> DataFrame:
    """Links (u, v) between similar texts of a piece, as spanning forests: rows (bucket, piece, side, sid, text).

    Side 0 is compared with side 1, and side 2 with itself.
    """
    def compare(t: pa.Table) -> pa.Table:
        piece, side = (t.column(x).to_numpy() for x in ("piece", "side"))
        sid, where, ident = np.unique(np.array(t.column("sid").to_pylist(), "S16"), return_index=True, return_inverse=True)
        texts = t.column("text")
        sets = [np.unique(shingle_hashes(texts[int(i)].as_py(), shingle)) for i in where]
        fp = np.array([majority(s) for s in sets], np.uint64)
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        order = np.argsort(piece, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], piece[order][1:] != piece[order][:-1], [True]]))
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            rows = order[lo:hi]
            first, second, whole = (np.unique(ident[rows[side[rows] == s]]) for s in range(3))
            for one, two in ((first, second), (whole, whole)):
                u, v = similar_pairs(sets, fp, one, two)
                us.append(u)
                vs.append(v)
        root = union_find(len(sid), np.concatenate(us), np.concatenate(vs))
        linked = np.flatnonzero(root != np.arange(len(sid)))
        whole = lambda x: pa.array([v.ljust(16, b"\0") for v in x.tolist()], pa.binary())  # noqa: E731  numpy drops closing zero bytes
        return pa.table({"u": whole(sid[linked]), "v": whole(sid[root[linked]])})

    return pieces.groupBy("bucket").applyInArrow(compare, "u binary, v binary")


def _alike(rows: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) of sets whose texts' fingerprints differ in `distance` bits at most, of rows (sid, fp): those of a fingerprint with its least set, and such sets of linked fingerprints."""
    own = spill(rows.select("sid", "fp").distinct(), "sim-fp")
    least = spill(own.groupBy("fp").agg(F.min("sid").alias("rep")), "sim-rep")
    found = link_fingerprints(least.select("fp", F.col("fp").alias("id")), distance)
    end = lambda c: least.select(F.col("fp").alias(c), F.col("rep").alias(f"{c}_rep"))
    near = found.join(end("u"), "u").join(end("v"), "v").select(F.col("u_rep").alias("u"), F.col("v_rep").alias("v"))
    out = spill(own.join(least, "fp").select(F.col("sid").alias("u"), F.col("rep").alias("v")).unionByName(near).filter("u <> v"), "sim-alike")
    drop_spilled(own, least)
    return out


def similar_texts(docs: DataFrame, keep: list[str], shingle: int = 5, distance: int | None = None) -> DataFrame:
    """Groups of similar texts: (keep..., group) for each row; keep has a column __key that stands for a row.

    Texts are linked whose sets of shingles have a Jaccard similarity of 0.8 at least, computed on whole texts; a
    group is what links reach. Equal sets are one point, and texts without a word are equal to each other. Points meet in cells
    of min-hashes; cells with the same points are one. A cell is cut into blocks of bounded size: each is compared
    with itself and with the cell's head, which ties a group of copies of any size at a cost that grows with its members, and in
    cells that hold more than one group after that, each block with each other. Tasks return spanning forests, no pairs.

    distance: texts whose SimHash fingerprints (of the same shingles, repeats included) differ in so many bits at most are linked too, found on the grid of link_fingerprints().
    """
    rows = spill(with_sketch(docs, keep, shingle), "sim-sketch")
    points = spill(rows.groupBy("sid").agg(F.min("__key").alias("__key"), F.first("n").alias("n"), F.first("cells").alias("cells")), "sim-points")
    placed = points.select("sid", "n", F.explode("cells").alias("cell"))
    mark = lambda i: F.xxhash64(F.lit(i), "sid")
    cells = placed.groupBy("cell").agg(F.count("*").alias("c"), F.sum("n").alias("hashes"), F.bit_xor(mark(1)).alias("s1"), F.bit_xor(mark(2)).alias("s2"), F.min(mark(3)).alias("head")).filter("c > 1")
    blocks = F.ceil(F.greatest(F.col("c") / SIDE, F.col("hashes") / SIDE_HASHES)).cast("int")
    cells = spill(cells.groupBy("s1", "s2", "c", "hashes", "head").agg(F.min("cell").alias("cell")).select("cell", "head", blocks.alias("blocks")), "sim-cells")
    members = spill(placed.join(cells.hint("merge"), "cell").select("cell", "sid", "n", "blocks", (mark(3) == F.col("head")).alias("first"), F.pmod(mark(4), "blocks").cast("int").alias("block")), "sim-members")
    ends = points.select("sid", "__key").join(members.select("sid").distinct(), "sid")
    texts = spill(docs.select("__key", "text").join(ends.hint("merge"), "__key").dropDuplicates(["__key"]).select("sid", "text"), "sim-texts")

    def links(pieces: DataFrame) -> DataFrame:
        n = buckets_for(pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], BUCKET_HASHES)
        dealt = pieces.select("sid", "piece", "side", F.pmod(F.xxhash64("piece"), F.lit(n)).cast("int").alias("bucket"))
        return spill(_links_of(dealt.join(texts.hint("merge"), "sid"), shingle), "sim-links")

    own = members.withColumn("b", F.explode(F.when(F.col("first"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))))
    tied = links(own.select("sid", "n", F.xxhash64("cell", "b").alias("piece"), F.lit(2).alias("side")))
    cc = spill(components(tied), "sim-tied")
    large = members.filter("blocks > 1").join(cc.hint("merge"), members["sid"] == cc["id"], "left").select("cell", "sid", "n", "blocks", "block", F.coalesce("component", "sid").alias("c"))
    mixed = large.groupBy("cell").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a <> b").select("cell")
    large = spill(large.join(mixed.hint("merge"), "cell"), "sim-large")
    other = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other <> block")
    piece = F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"), F.lit("pair")).alias("piece")
    rest = links(other.select("sid", "n", piece, (F.col("block") > F.col("other")).cast("int").alias("side")))
    found = tied.unionByName(rest)
    alike = [] if distance is None else [_alike(rows, distance)]
    for more in alike:
        found = found.unionByName(more)
    groups = spill(components(found), "sim-cc")
    drop_spilled(*alike, points, cells, members, texts, tied, cc, large, rest)
    return rows.join(groups.hint("merge"), rows["sid"] == groups["id"], "left").select(*keep, F.coalesce("component", "sid").alias("group"))

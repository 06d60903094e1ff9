"""Quality rules: robust multivariate outliers per language and source."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement
from math import exp, lgamma, log
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, drop_spilled, spill, spill_bucketed

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Names of the transformed statistics, and the least standard deviation that each is taken to have. Many
#: groups have a statistic that is constant for most documents; without a floor any other value would be infinitely far.
FEATURES = {"log_words": 0.25, "word_length": 0.08, "symbols": 0.25, "dup_lines": 0.25, "repeats": 0.2, "doubled": 0.1}
#: Statistics are integers in units of 1/SCALE, so that sums of products are exact and the same in any order; they fit 64 bits for 10**12 documents.
SCALE = 256
#: Share of a group's documents that the determinant is minimised over; concentration steps from each start, and in all at most.
SUPPORT, FIRST_STEPS, STEPS = 0.75, 2, 12
#: Steps end when no group's log determinant moves by more.
STILL = 0.05
#: Documents that the estimate of a group's language counts for in the group's own, and that of all documents in a language's.
PRIOR = 100
#: Share of a normal group's documents that reweighting keeps, and share of those that may be taken for outliers.
REWEIGHT, OUTLIERS = 0.975, 1e-6
#: Bins of squared distances: BIN_STEPS to a factor of e.
BINS, BIN_STEPS = 2400, 100
#: Rows of a bucket of statistics, about, and salts of the join of documents with their group's estimate.
BUCKET, SALTS = 50_000, 8
#: Starts of the concentration steps.
STARTS = 4


def chi2_cdf(x: float, p: int) -> float:
    """Share of a chi-square of p degrees below x: the series of the incomplete gamma function."""
    a, t = p / 2, x / 2
    term = total = 1 / a
    k = 0
    while term > 1e-17 * total:
        k += 1
        term *= t / (a + k)
        total += term
    return total * exp(a * log(t) - t - lgamma(a)) if x > 0 else 0.0


def chi2_quantile(share: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, p) < share else (low, mid)
    return high


def consistency(share: float, p: int) -> float:
    """By what the covariance of a normal sample's nearest share must be multiplied to be that of the whole."""
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


def n_repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of `window` (a power of two) words that are found twice or more in the text, the first included."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    width = 1
    while width < window:  # ranks of windows twice as wide, from pairs of ranks: exact, no hashing
        pair = rank[:-width] * (n + 1) + rank[width:]
        values, rank, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if len(values) == len(pair):
            return 0
        width *= 2
    starts = np.flatnonzero(counts[rank] > 1)
    cover = np.zeros(n + 1, np.int64)
    cover[starts] += 1
    np.subtract.at(cover, starts + window, 1)
    return int((np.cumsum(cover) > 0).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_doubled) of a whole text; null: none."""
    if not text:
        return 0, 0, 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split at exactly [\x20\x09-\x0D]
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), n_repeat_words(words), len(lines), sum(map(eq, words, words[1:]))


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_doubled) of each row; one narrow pass over whole texts."""
    src = docs.select(*keep, "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_doubled"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(len(keep)).to_pylist()
            cols = list(zip(*map(text_stats, texts), strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *(pa.array(c, pa.int64()) for c in cols)], [*keep, *names])

    head = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(run, f"{head}, " + ", ".join(f"{n} long" for n in names))


def with_features(stats: DataFrame) -> DataFrame:
    """Adds x0.. : the transformed statistics as integers in units of 1/SCALE."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    raw = [
        F.log1p(F.col("n_words").cast("double")),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.log1p(100 * F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / n),
        F.sqrt(F.col("n_doubled") / n),
    ]
    return stats.withColumns({f"x{i}": F.round(x * SCALE).cast("long") for i, x in enumerate(raw)})


def mean_and_cov(n: int, sums: list[int], products: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of n rows, from their sums and sums of products in units of 1/SCALE; n = 0: zeros."""
    p = len(sums)
    n = max(n, 1)
    cov = np.zeros((p, p))
    for (i, j), v in zip(combinations_with_replacement(range(p), 2), products, strict=True):
        cov[i, j] = cov[j, i] = (v * n - sums[i] * sums[j]) / n / n / SCALE**2  # exact integers first, so that nothing cancels
    return np.array([x / n / SCALE for x in sums]), cov


def shrunk(n: int, mu: np.ndarray, cov: np.ndarray, above_mu: np.ndarray, above_cov: np.ndarray, prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of n documents together with `prior` more that are spread as the estimate above: one law for any n."""
    w, d = n / (n + prior), mu - above_mu
    return w * mu + (1 - w) * above_mu, w * cov + (1 - w) * above_cov + w * (1 - w) * np.outer(d, d)


def scaled(scale: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Covariance with these scales and the correlations of a second matrix."""
    spread = np.sqrt(np.diag(signs))
    ok = spread > 0
    r = np.eye(len(scale))
    r[np.ix_(ok, ok)] = signs[np.ix_(ok, ok)] / np.outer(spread[ok], spread[ok])
    return r * np.outer(scale, scale)


_PARAMS = "key string, start int, n long, mu array<double>, cov array<double>, prec array<double>, logdet double"


def _params(rows: list[tuple], floors: np.ndarray, factor: float = 1.0) -> pa.RecordBatch:
    """Rows (key, start, n, mu, cov) with the inverse and the log determinant of the covariance, times factor, with its floors."""
    out: list[list] = [[] for _ in range(7)]
    for key, start, n, mu, cov in rows:
        full = factor * cov + np.diag(floors**2)
        for c, v in zip(out, (key, start, n, mu.tolist(), cov.ravel().tolist(), np.linalg.inv(full).ravel().tolist(), float(np.linalg.slogdet(full)[1])), strict=True):
            c.append(v)
    many = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int32(), pa.int64(), many, many, many, pa.float64()), strict=True)], ["key", "start", "n", "mu", "cov", "prec", "logdet"])


def _estimates(moments: DataFrame, tree: DataFrame, floors: np.ndarray, factor: float = 1.0) -> DataFrame:
    """Parameters of each (key, start) from its sums, shrunk towards those of the key above; level by level, a small row for each group."""
    p = len(floors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                mu, cov = mean_and_cov(r["n"], r["sums"], r["products"])
                if r["above_mu"] is not None:
                    mu, cov = shrunk(r["n"], mu, cov, np.array(r["above_mu"]), np.array(r["above_cov"]).reshape(p, p))
                rows.append((r["key"], r["start"], r["n"], mu, cov))
            yield _params(rows, floors, factor)

    placed = moments.join(tree, "key")
    none = F.lit(None).cast("array<double>")
    levels = [placed.filter("level = 0").select("key", "start", "n", "sums", "products", none.alias("above_mu"), none.alias("above_cov")).mapInArrow(run, _PARAMS)]
    for k in (1, 2):
        above = levels[-1].select(F.col("key").alias("above"), "start", F.col("mu").alias("above_mu"), F.col("cov").alias("above_cov"))
        own = placed.filter(F.col("level") == k).join(above, ["above", "start"]).select("key", "start", "n", "sums", "products", "above_mu", "above_cov")
        levels.append(own.mapInArrow(run, _PARAMS))
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


def _distance(p: int):
    d = [F.col(f"x{i}") / SCALE - F.col("mu")[i] for i in range(p)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(i, p):
            total = total + (1.0 if i == j else 2.0) * d[i] * d[j] * F.col("prec")[i * p + j]
    return total


def distances(x: np.ndarray, mu: list[float], prec: list[float]) -> np.ndarray:
    """Squared distances of rows in units of 1/SCALE; term by term, so that a row's is the same in any company."""
    d = (x / SCALE - np.array(mu)).T
    p, total = len(mu), np.zeros(len(x))
    for i in range(p):
        for j in range(i, p):
            total += (1.0 if i == j else 2.0) * prec[i * p + j] * d[i] * d[j]
    return total


def bins(d: np.ndarray) -> np.ndarray:
    """Logarithmic bins of squared distances."""
    return np.clip(np.floor((np.log(np.maximum(d, 0) + 1e-9) + 6.0) * BIN_STEPS), 0, BINS).astype(np.int32)


def sums_of(x: np.ndarray) -> tuple[int, list[int], list[int]]:
    """Count, sums and sums of products of rows of whole numbers."""
    pairs = combinations_with_replacement(range(x.shape[1]), 2)
    return len(x), x.sum(0).tolist(), [int((x[:, i] * x[:, j]).sum()) for i, j in pairs]


_SUMS = "key string, start int, n long, sums array<long>, products array<long>"
_SUMS_TYPES = pa.schema([("key", pa.string()), ("start", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("products", pa.list_(pa.int64()))])


class Rows:
    """Rows (grp, lang, x0..) in buckets of bounded size, and what is asked of them: all rows of a group, a language, or the whole (key `*`).

    Buckets take rows as they come, so a group of any size is spread over many, and a pass is a task for each. A bucket
    meets those keys that it has rows of, with their parameters; what it answers are counts and sums.
    """

    def __init__(self, rows: DataFrame, p: int):
        self.p, n = p, buckets_for(rows.count(), BUCKET, 4)
        dealt = rows.select("grp", "lang", *[f"x{i}" for i in range(p)], F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int").alias("bucket"))
        self.rows = spill_bucketed(dealt.repartition(n, "bucket"), "mcd-buckets", "bucket", n)
        self.needs = spill(self.rows.select("bucket", F.explode(F.array("grp", "lang", F.lit("*"))).alias("key")).distinct(), "mcd-needs", tidy=False)

    def ask(self, side: DataFrame, each, schema: str, types: pa.Schema) -> DataFrame:
        """What `each`(x, row of side) lists, for every bucket and every row of side (key, ...) whose key it holds."""
        p = self.p

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            x = np.stack([left.column(f"x{i}").to_numpy() for i in range(p)], 1) if left.num_rows else np.zeros((0, p), np.int64)
            where: dict[str, np.ndarray] = {"*": np.arange(len(x))}
            for c in ("grp", "lang"):
                if not left.num_rows:
                    break
                coded = left.column(c).combine_chunks().dictionary_encode()
                codes, values = coded.indices.to_numpy(), coded.dictionary.to_pylist()
                order = np.argsort(codes, kind="stable")
                cuts = np.searchsorted(codes[order], np.arange(len(values) + 1))
                where |= {v: order[cuts[k] : cuts[k + 1]] for k, v in enumerate(values)}
            rows = [r for q in right.to_pylist() if q["key"] in where for r in each(x[where[q["key"]]], q)]
            cols = list(zip(*rows, strict=True)) or [()] * len(types)
            return pa.table([pa.array(c, f.type) for c, f in zip(cols, types, strict=True)], schema=types)

        return self.rows.groupBy("bucket").cogroup(side.join(self.needs, "key").groupBy("bucket")).applyInArrow(run, schema)

    def moments(self, side: DataFrame, each) -> DataFrame:
        """(key, start, n, sums, products) added up over buckets; each: lists (key, start, n, sums, products)."""
        p, q = self.p, self.p * (self.p + 1) // 2
        parts = self.ask(side, each, _SUMS, _SUMS_TYPES)
        add = lambda c, k: F.array(*[F.sum(F.col(c)[i]) for i in range(k)]).alias(c)
        return parts.groupBy("key", "start").agg(F.sum("n").alias("n"), add("sums", p), add("products", q))

    def quantile(self, side: DataFrame, share: float) -> DataFrame:
        """(key, start, q): the first bin of distances up to which a key has the share of its rows."""
        def each(x, r):
            at, n = np.unique(bins(distances(x, r["mu"], r["prec"])), return_counts=True)
            return [(r["key"], r["start"], b, c) for b, c in zip(at.tolist(), n.tolist(), strict=True)]

        hist = self.ask(side, each, "key string, start int, bin int, c long", pa.schema([("key", pa.string()), ("start", pa.int32()), ("bin", pa.int32()), ("c", pa.int64())]))
        hist = hist.groupBy("key", "start", "bin").agg(F.sum("c").alias("c"))
        pairs = hist.groupBy("key", "start").agg(F.sum("c").alias("t"), F.array_sort(F.collect_list(F.struct("bin", "c"))).alias("h"))  # BINS + 1 entries at most
        folded = F.aggregate("h", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("q")), lambda a, x: F.struct((a["sum"] + x["c"]).alias("sum"), F.when((a["q"] < 0) & (a["sum"] + x["c"] >= share * F.col("t")), x["bin"]).otherwise(a["q"]).alias("q")))
        return pairs.select("key", "start", folded["q"].alias("q"))


def fit_mcd(rows: DataFrame, p: int = len(FEATURES)) -> DataFrame:
    """Minimum covariance determinant of each group: (key, mu, prec), over rows (grp, lang, x0..), grp and lang not null.

    Groups lie in languages and these in the whole (key `*`); each is estimated from all of its documents and
    shrunk towards the one above by PRIOR documents' weight, whatever its size. Four starts (medians with absolute deviations; these with the
    correlations of tanh of the scores, or of their spatial signs; mean and covariance: after Hubert, Rousseeuw and Verdonck 2012) take
    FIRST_STEPS concentration steps each (Rousseeuw and Van Driessen 1999): the SUPPORT share nearest by Mahalanobis distance gives the next
    mean and covariance. The start with the least determinant goes on until determinants are still. The estimate is then made
    consistent with a normal sample and reweighted once: mean and covariance of all documents within the REWEIGHT quantile.
    A step is two passes over small integers (see Rows): a histogram of distances by group finds the share's bound (to 1 % of the distance), then
    sums are taken within it; a group of any size is only ever summed up in parts.
    """
    floors = np.array(list(FEATURES.values()))[:p]
    xs = [f"x{i}" for i in range(p)]
    up = lambda key, above, level: F.struct(key.alias("key"), above.alias("above"), F.lit(level).alias("level"))
    none = F.lit(None).cast("string")
    tree = spill(rows.select("grp", "lang").distinct().select(F.explode(F.array(up(F.col("grp"), F.col("lang"), 2), up(F.col("lang"), F.lit("*"), 1), up(F.lit("*"), none, 0))).alias("t")).select("t.*").distinct(), "mcd-tree", tidy=False)
    held = Rows(rows, p)
    every = rows.select(F.explode(F.array("grp", "lang", F.lit("*"))).alias("key"), *xs)
    # values are integers, so the exact median needs a count for each distinct value only
    med = spill(every.groupBy("key").agg(F.array(*[F.median(x).cast("double") for x in xs]).alias("m")), "mcd-median", tidy=False)
    mad = every.join(med, "key").groupBy("key").agg(F.array(*[F.greatest(F.median(F.abs(F.col(x) - F.col("m")[i])) * 1.4826, F.lit(float(floors[i] * SCALE))) for i, x in enumerate(xs)]).alias("s"))
    med = spill(med.join(mad, "key"), "mcd-scale", tidy=False)

    def views(x: np.ndarray, r: dict) -> list[tuple]:
        z = (x - np.array(r["m"])) / np.array(r["s"])
        size = np.sqrt((z * z).sum(1, keepdims=True))
        seen = np.tanh(z), np.divide(z, size, out=np.zeros_like(z), where=size > 0), x / SCALE
        return [(r["key"], k + 1, *sums_of(np.rint(v * SCALE).astype(np.int64))) for k, v in enumerate(seen)]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                mu, cov = mean_and_cov(r["n"], r["sums"], r["products"])
                m, s = np.array(r["m"]) / SCALE, np.array(r["s"]) / SCALE
                if r["start"] == STARTS - 1:
                    out += [(r["key"], 0, r["n"], m, np.diag(s**2)), (r["key"], r["start"], r["n"], mu, cov)]
                else:
                    out.append((r["key"], r["start"], r["n"], m, scaled(s, cov + (np.outer(mu, mu) if r["start"] == 2 else 0))))
            yield _params(out, floors)

    def near(x: np.ndarray, r: dict) -> list[tuple]:
        return [(r["key"], r["start"], *sums_of(x[bins(distances(x, r["mu"], r["prec"])) <= r["q"]]))]

    params = spill(held.moments(med, views).join(med, "key").mapInArrow(begin, _PARAMS), "mcd-start", tidy=False)
    for step in range(STEPS):
        at = params.select("key", "start", "mu", "prec")
        bound = held.quantile(at, SUPPORT).join(at, ["key", "start"])
        after = spill(_estimates(spill(held.moments(bound, near), "mcd-moments", tidy=False), tree, floors), "mcd-step", tidy=False)
        if step == FIRST_STEPS - 1:  # only the best start of each group goes on
            rest = [c for c in after.columns if c not in ("key", "start")]
            after = spill(after.groupBy("key").agg(F.min_by(F.struct(*rest), F.struct("logdet", "start")).alias("b")).select("key", F.lit(0).alias("start"), *[f"b.{c}" for c in rest]), "mcd-best", tidy=False)
        still = step >= FIRST_STEPS and not after.join(params.select("key", F.col("logdet").alias("was")), "key").filter(F.abs(F.col("logdet") - F.col("was")) > STILL).limit(1).count()
        params = after
        if still:
            break
    scale, reach = consistency(SUPPORT, p), chi2_quantile(REWEIGHT, p)

    def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _params([(r["key"], 0, r["n"], np.array(r["mu"]), np.array(r["cov"]).reshape(p, p)) for r in b.to_pylist()], floors, scale)

    def inside(x: np.ndarray, r: dict) -> list[tuple]:
        return [(r["key"], 0, *sums_of(x[distances(x, r["mu"], r["prec"]) <= reach]))]

    # a group without a document inside has its estimate from above alone
    moments = held.moments(params.mapInArrow(widened, _PARAMS).select("key", "mu", "prec"), inside)
    return spill(_estimates(spill(moments, "mcd-moments", tidy=False), tree, floors, consistency(REWEIGHT, p)).select("key", "mu", "prec"), "mcd", tidy=False)


def groups(stats: DataFrame) -> DataFrame:
    """Adds grp, the language and source a document is judged in, and lang_key, its language. Nulls are a language and a source of their own."""
    one = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"__{c}")), F.lit("-"))
    return stats.withColumn("grp", F.to_json(F.struct(one("lang").alias("l"), one("source").alias("s")))).withColumn("lang_key", F.to_json(F.struct(one("lang").alias("l"))))


def judge(docs: DataFrame, keep: list[str] | None = None, outliers: float = OUTLIERS) -> DataFrame:
    """Judge every document: (keep..., n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept).

    base_failed: under 20 words, or over 30 % of the words in repeated 8-word windows. Of the others, the robust squared
    Mahalanobis distance of the transformed statistics within the document's language and source (see fit_mcd()) decides: kept is
    distance <= the 1 - outliers quantile of a chi-square. distance is null where the base rule failed. Only
    documents that pass the base rule shape the estimates. Null and empty texts have no words and fail the base
    rule; repeated rows are judged alike; an empty table gives an empty result. Whole texts of any length are read, one at a time. Of other columns
    only those in keep are read, and keep can't hold names of the result.
    """
    keep = list(keep or ["doc_id"])
    # under names of their own, so that columns of the input can't clash
    src = docs.select(*keep, F.col("lang").alias("__lang"), F.col("source").alias("__source"), *[] if "text" in keep else ["text"])
    stats = with_stats(src, [*keep, "__lang", "__source"])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stats = spill(with_features(stats).withColumn("base_failed", failed), "quality-stats")
    good = groups(stats.filter(~F.col("base_failed")))
    xs = [f"x{i}" for i in range(len(FEATURES))]
    rows = spill(good.select("grp", F.col("lang_key").alias("lang"), *xs), "mcd-rows")
    params = fit_mcd(rows)
    drop_spilled(rows)
    # salted, so that a group with a third of the rows is spread over tasks; where the estimates are few Spark broadcasts them
    salted = params.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    good = good.withColumn("key", F.col("grp")).withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    judged = good.join(salted, ["key", "__salt"]).withColumn("distance", _distance(len(xs)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = judged.select(*keep, *names, "distance").unionByName(stats.filter("base_failed").select(*keep, *names, F.lit(None).cast("double").alias("distance")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= chi2_quantile(1 - outliers, len(xs))))

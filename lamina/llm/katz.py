"""LM scoring: Katz backoff with Good-Turing discounts and exactly normalised backoff weights.

The corpus is cut once into blocks of tokens. A block never sees the whole model: it asks the buckets
that hold its own n-grams, and they answer in the order of the question. So all that moves is one record per
distinct n-gram of a block, and nothing that grows with the corpus is ever in one place.

1. Blocks: tokens as numbers into the block's own vocabulary; words are 64-bit hashes.
2. Unigrams: buckets by word add up counts, keep them as the table's part `m`, and answer with them and with the
   word's number (`r`). Numbers follow the counts within each bucket, so frequent words have small ones.
3. Bigrams: buckets by context add up counts, keep them (`m`), and answer with each count and, for each context, with
   what its backoff weight is made of, in whole numbers: how many successors have counts 1 to K, all counts, and the same of
   the successors' unigram counts. A context too frequent for one bucket is split over several by
   successor; a block asks all of them, and adds.
4. Scores: each token's probability by recursion, bigram, else weight times unigram, else weight times unknown word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, free, spill, spill_bucketed, trim

#: Tokens of a block, and vocabulary entries or tokens of a bucket, about.
BLOCK, UNI_BUCKET, BI_BUCKET = 1_500_000, 300_000, 1_000_000
#: Counts up to K are discounted.
K = 5
#: No word has a blank, so this stands for the end, which is also the context of a text's first token.
END = b" "


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string; unpack() needs their types."""
    head = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack(data: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, "<i8", len(types))
    out, at = [], 8 * len(types)
    for size, t in zip(sizes.tolist(), types, strict=True):
        out.append(np.frombuffer(raw, t, size // np.dtype(t).itemsize, at))
        at += size
    return out


def planes(a: np.ndarray) -> np.ndarray:
    """64-bit numbers as eight rows of bytes; the rows of high bytes, mostly zero, compress to nothing."""
    return np.ascontiguousarray(np.asarray(a, "<u8").view(np.uint8).reshape(-1, 8).T)


def unplanes(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a.reshape(8, -1).T).view("<u8").ravel()


def mix(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (splitmix64)."""
    a = a.astype(np.uint64)
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def discounts(n: list[int], k: int = K) -> np.ndarray:
    """d[1..k]: Katz's discounts from n[1..k+1], the numbers of n-grams by count; n[0] is not used. d[0] stands for counts over k: 1.

    Where the counts of counts are too few or too uneven for Good-Turing, absolute discounting takes its place.
    """
    d = np.ones(k + 1)
    n1, n2 = n[1], n[2]
    if n1 and all(n[1 : k + 2]):
        a = (k + 1) * n[k + 1] / n1
        if a < 1:
            d[1:] = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
            if (d[1:] > 0).all() and (d[1:] < 1).all():
                return d
    off = n1 / (n1 + 2 * n2) if n1 else 0.5
    d[1:] = [(r - off) / r for r in range(1, k + 1)]
    d[1:] = np.clip(d[1:], 0.05, 0.95)
    return d


class Unigrams:
    """Probabilities by count: Good-Turing, and the mass set free is that of any unknown word."""

    def __init__(self, total: int, types: int, n: list[int]):
        self.total, self.types = total, types
        d = discounts(n)
        freed = sum((1 - d[r]) * r * n[r] for r in range(1, K + 1))
        self.d, self.over = d, total if freed > 0 else total + 1
        self.unknown = (freed + self.over - total) / self.over

    def p(self, c: np.ndarray) -> np.ndarray:
        p = np.where(c > K, 1.0, self.d[np.minimum(c, K)]) * c / max(self.over, 1)
        return np.where(c > 0, p, self.unknown)


def blocks(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, docs, held, lens, tokens, vocab, counts): the corpus in blocks; rows (doc_id, text, held). Counts are those in training."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    arrow_id = pa.int64() if id_type == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh3_64_intdigest

        part, made = TaskContext.get().partitionId(), 0
        words: defaultdict[bytes, int] = defaultdict()

        def fresh():
            words.clear()
            words.default_factory = words.__len__
            words[END]  # number 0
            return [], [], [], [], 0

        def emit():
            tokens = np.concatenate(arrays)
            # frequent words get small numbers, which compress; the end keeps 0
            uses = np.bincount(tokens, minlength=len(words))
            uses[0] = len(tokens) + 1
            order = np.argsort(-uses, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            tokens = rank[tokens]
            train = np.repeat(~np.array(held), lens)
            counts = np.bincount(tokens[train], minlength=len(words)).astype("<u4")
            vocab = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))[order]
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) + made], pa.int64()), pa.array([ids], pa.list_(arrow_id) if arrow_id else None), pa.array([held]), pa.array([lens], pa.list_(pa.int32())), pa.array([pack(planes(tokens))]), pa.array([pack(vocab, counts)]), pa.array([len(vocab)], pa.int64())],
                ["block", "docs", "held", "lens", "tokens", "vocab", "entries"],
            )

        ids, held, lens, arrays, n = fresh()
        for b in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            for d, t, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                own = [words[w] for w in (t or "").encode().lower().split()]
                own.append(0)
                ids.append(d)
                held.append(h)
                lens.append(len(own))
                arrays.append(np.array(own, np.uint32))
                n += len(own)
                if n >= block:
                    yield emit()
                    made += 1
                    ids, held, lens, arrays, n = fresh()
                    trim()
        if ids:
            yield emit()
        words.clear()
        arrays.clear()
        trim()

    return docs.select("doc_id", "text", "held").mapInArrow(run, f"block long, docs array<{id_type}>, held array<boolean>, lens array<int>, tokens binary, vocab binary, entries long")


def split_by(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its rows in their order)."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    values, starts = np.unique(bucket[order], return_index=True)
    for v, s, e in zip(values.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
        yield v, order[s:e]


_ANSWER = "kind string, bucket int, block long, data binary, stats array<long>"


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [()] * 5
    return pa.table({"kind": pa.array(cols[0], pa.string()), "bucket": pa.array(cols[1], pa.int32()), "block": pa.array(cols[2], pa.int64()), "data": pa.array(cols[3], pa.binary()), "stats": pa.array(cols[4], pa.list_(pa.int64()))})


def _added(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by place: exact below 2**53."""
    return np.bincount(at, values, n).astype(np.int64)


def _count_stats(counts: np.ndarray) -> list[int]:
    """[sum, distinct, n1 .. n(K+1)] of the counts above zero."""
    by = np.bincount(np.minimum(counts[counts > 0], K + 2).astype(np.int64), minlength=K + 3)
    return [int(counts.sum()), int((counts > 0).sum()), *by[1 : K + 2].tolist()]


def _total_stats(answers: DataFrame) -> list[int]:
    row = answers.filter("kind = 'n'").agg(*[F.sum(F.col("stats")[i]) for i in range(K + 3)]).first()
    return [int(x or 0) for x in row]


def unigrams(corpus: DataFrame) -> DataFrame:
    """Answers to every block's vocabulary, counts of counts, and the unigram table."""
    n = buckets_for(corpus.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0], UNI_BUCKET)

    def ask(batches):
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                vocab, counts = unpack(data, "<u8", "<u4")
                got = [(k, block, pack(vocab[at], counts[at])) for k, at in split_by(vocab % np.uint64(n))]
                cols = list(zip(*got, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], ["bucket", "block", "data"])

    def answer(t: pa.Table) -> pa.Table:
        bucket, asked = t.column("bucket")[0].as_py(), t.column("block").to_pylist()
        parts = [unpack(d, "<u8", "<u4") for d in t.column("data").to_pylist()]
        keys, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = _added(inv, np.concatenate([p[1] for p in parts]), len(keys))
        known = counts > 0
        number = np.empty(len(keys), np.int64)
        number[np.lexsort((keys, -counts))] = np.arange(len(keys)) * n + bucket
        rows, at = [], 0
        for block, p in zip(asked, parts, strict=True):
            own = inv[at : at + len(p[0])]
            rows.append(("r", bucket, block, pack(planes(counts[own]), planes(number[own])), None))
            at += len(p[0])
        rows.append(("n", bucket, None, None, _count_stats(counts)))
        rows.append(("m", bucket, None, pack(keys[known], planes(counts[known]), planes(number[known])), None))
        return _rows(rows)

    return corpus.select("block", "vocab").mapInArrow(ask, "bucket int, block long, data binary").groupBy("bucket").applyInArrow(answer, _ANSWER)


class Block:
    """A block with the unigram counts of its vocabulary, and the questions it has about bigrams."""

    def __init__(self, row: dict, answers: dict[int, bytes], uni_buckets: int):
        self.docs, self.held, self.lens = row["docs"], np.array(row["held"]), np.array(row["lens"], np.int64)
        self.tokens = unplanes(unpack(row["tokens"], "u1")[0]).astype(np.int64)
        self.vocab, _ = unpack(row["vocab"], "<u8", "<u4")
        self.count, self.number = np.zeros(len(self.vocab), np.int64), np.zeros(len(self.vocab), np.uint64)
        for k, at in split_by(self.vocab % np.uint64(uni_buckets)):
            self.count[at], self.number[at] = map(unplanes, unpack(answers[k], "u1", "u1"))

    def questions(self, uni: Unigrams, buckets: int, share: int) -> None:
        """Distinct known bigrams, dealt to buckets: self.parts holds (bucket, contexts, runs, places of the bigrams)."""
        before = np.concatenate([[0], self.tokens[:-1]])
        before[np.concatenate([[0], np.cumsum(self.lens)[:-1]])] = 0
        self.before = before
        both = (self.count[before] > 0) & (self.count[self.tokens] > 0)
        self.at = np.flatnonzero(both)
        pair = before[both] * len(self.vocab) + self.tokens[both]
        self.pairs, self.inv = np.unique(pair, return_inverse=True)
        ctx, word = np.divmod(self.pairs, len(self.vocab))
        train = np.repeat(~self.held, self.lens)[both]
        self.seen = np.bincount(self.inv[train], minlength=len(self.pairs)).astype("<u4")
        pieces = -(-self.count // share)  # of a context; its successors are split over as many buckets
        home = lambda c, piece: mix(self.number[c] + np.uint64(0x9E3779B97F4A7C15) * piece.astype(np.uint64)) % np.uint64(buckets)
        bucket = home(ctx, (mix(self.number[word]) >> np.uint64(32)) % np.maximum(pieces[ctx], 1).astype(np.uint64)).astype(np.int64)
        self.ctx, self.word = ctx, word
        # every piece of a known context is asked for its sums, with or without known bigrams
        own = np.unique(before[self.count[before] > 0])
        reps = pieces[own]
        ask_ctx = np.repeat(own, reps)
        ask_piece = np.arange(len(ask_ctx)) - np.repeat(np.cumsum(reps) - reps, reps)
        ask_bucket = home(ask_ctx, ask_piece).astype(np.int64)
        # two pieces of a context may share a bucket: asked once
        asked = np.unique(np.stack([ask_bucket, ask_ctx], 1), axis=0) if len(own) else np.zeros((0, 2), np.int64)
        of = {k: at for k, at in split_by(bucket)}
        self.parts = []
        for k, rows in split_by(asked[:, 0]):
            contexts = asked[rows, 1]
            at = of.get(k, np.zeros(0, np.int64))
            runs = np.searchsorted(ctx[at], contexts, "right") - np.searchsorted(ctx[at], contexts, "left")
            self.parts.append((k, contexts, runs, at))
        self.p1 = uni.p(self.count)


def _question(b: Block, contexts: np.ndarray, runs: np.ndarray, at: np.ndarray) -> bytes:
    return pack(planes(b.number[contexts]), runs.astype("<u4"), planes(b.number[b.word[at]]), b.seen[at], planes(b.count[b.word[at]]))


def bigrams(corpus: DataFrame, uni_answers: DataFrame, uni: Unigrams, uni_buckets: int, buckets: int, share: int) -> DataFrame:
    """Answers to every block's bigrams, counts of counts, and the bigram table."""
    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        b = _block(left, right, uni_buckets)
        b.questions(uni, buckets, share)
        rows = [(k, left.column("block")[0].as_py(), _question(b, c, runs, at)) for k, c, runs, at in b.parts]
        del b
        trim()
        cols = list(zip(*rows, strict=True)) or [()] * 3
        return pa.table({"bucket": pa.array(cols[0], pa.int32()), "block": pa.array(cols[1], pa.int64()), "data": pa.array(cols[2], pa.binary())})

    def answer(t: pa.Table) -> pa.Table:
        trim()  # what the bucket before left
        bucket, asked = t.column("bucket")[0].as_py(), t.column("block").to_pylist()
        parts = [unpack(d, "u1", "<u4", "u1", "<u4", "u1") for d in t.column("data").to_pylist()]
        parts = [(unplanes(c), runs, unplanes(w), seen, unplanes(of_word)) for c, runs, w, seen, of_word in parts]
        contexts, cinv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        ctx = np.repeat(cinv, np.concatenate([p[1] for p in parts]))
        key = np.concatenate([p[2] for p in parts])
        seen, of_word = (np.concatenate([p[i] for p in parts]) for i in (3, 4))
        order = np.lexsort((key, ctx))
        new = np.concatenate([[True], (ctx[order][1:] != ctx[order][:-1]) | (key[order][1:] != key[order][:-1])]) if len(order) else np.zeros(0, bool)
        gram = np.empty(len(order), np.int64)
        gram[order] = np.cumsum(new) - 1
        first = order[new]
        r = _added(gram, seen, len(first))
        known = r > 0
        c = ctx[first][known]
        rk = r[known]
        uk = of_word[first][known]  # the successors' unigram counts
        number_of = lambda which: np.bincount(c[which], minlength=len(contexts))
        above = np.where(uk > K, uk, 0)
        sums = np.stack([*(number_of(rk == x) for x in range(1, K + 1)), _added(c, rk, len(contexts)), *(number_of(uk == x) for x in range(1, K + 1)), _added(c, above, len(contexts))])
        rows, at, cat = [], 0, 0
        for block, p in zip(asked, parts, strict=True):
            n, m = len(p[3]), len(p[0])
            own = cinv[cat : cat + m]
            rows.append(("r", bucket, block, pack(planes(r[gram[at : at + n]]), planes(sums[:, own].ravel())), None))
            at, cat = at + n, cat + m
        rows.append(("n", bucket, None, None, _count_stats(r)))
        rows.append(("m", bucket, None, pack(planes(contexts), np.bincount(c, minlength=len(contexts)).astype("<u4"), planes(key[first][known]), planes(rk)), None))
        return _rows(rows)

    asked = corpus.groupBy("block").cogroup(uni_answers.filter("kind = 'r'").groupBy("block")).applyInArrow(ask, "bucket int, block long, data binary")
    return asked.groupBy("bucket").applyInArrow(answer, _ANSWER)


def _block(left: pa.Table, right: pa.Table, uni_buckets: int) -> Block:
    row = {c: left.column(c)[0].as_py() for c in ("docs", "held", "lens", "tokens", "vocab")}
    return Block(row, dict(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist(), strict=True)), uni_buckets)


def score(docs: DataFrame, held, with_tokens: bool = False) -> DataFrame:
    """Score every document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score[, token_scores]), log10.

    `held` is a boolean column; documents where it is false or null are learned from. A-Z are lower-cased; a text is its
    words and one end. base_score adds one to every count; score is that of the Katz model. Both
    give the words not seen in training one probability together. Null and empty texts are their end alone. Rows
    that repeat count and are scored one by one; an empty table gives an empty result; with nothing to learn from, all
    scores are 0. Very long texts are blocks of their own, scored whole; columns other than doc_id and text are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # scoring runs one task for each bucket of blocks: they follow the shuffles' width and the input's splits
    files = min(100_000, max(48, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions()))
    corpus = spill_bucketed(blocks(docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held"))), "lm-blocks", "block", files)
    entries, tokens = corpus.agg(F.coalesce(F.sum("entries"), F.lit(0)), F.coalesce(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
    uni_buckets, buckets = buckets_for(entries, UNI_BUCKET), buckets_for(tokens, BI_BUCKET)
    one = spill(unigrams(corpus), "lm-unigrams", ["kind"])
    total, types, *n = _total_stats(one)
    uni = Unigrams(total, types, [0, *n])
    share = max(1, BI_BUCKET // 4)
    two = spill(bigrams(corpus, one, uni, uni_buckets, buckets, share), "lm-bigrams", ["kind"])
    d2 = discounts([0, *_total_stats(two)[2:]])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        trim()
        level = right.column("level").to_numpy()
        b = _block(left, right.filter(pa.array(level == 1)), uni_buckets)
        b.questions(uni, buckets, share)
        second = right.filter(pa.array(level == 2))
        answers = dict(zip(second.column("bucket").to_pylist(), second.column("data").to_pylist(), strict=True))
        r = np.zeros(len(b.pairs), np.int64)
        sums = np.zeros((2 * K + 2, len(b.vocab)), np.int64)
        for k, contexts, _, at in b.parts:
            found, part = unpack(answers[k], "u1", "u1")
            r[at] = unplanes(found)
            sums[:, contexts] += unplanes(part).astype(np.int64).reshape(len(sums), -1)
        total_c, ranks = sums[K], np.arange(1, K + 1)
        freed = ((1 - d2[1:]) * ranks) @ sums[:K]
        over = total_c + (freed <= 0)
        # what is free for words that don't follow: whole numbers are subtracted before anything is rounded, so a context that
        # has nearly all words behind it loses no digits, and what is left is at least the unknown word's share
        rest = (uni.over - sums[-1] - (uni.d[1:] * ranks) @ sums[K + 1 : -1]) / max(uni.over, 1)
        weight = np.where(total_c > 0, (freed + (over - total_c)) / np.maximum(over, 1) / rest, 1.0)
        p = weight[b.before] * b.p1[b.tokens]
        ctx = b.ctx
        seen = np.where(r > K, 1.0, d2[np.minimum(r, K)]) * r / over[ctx]
        p[b.at] = np.where(r > 0, seen, weight[ctx] * b.p1[b.word])[b.inv]
        starts = np.cumsum(b.lens) - b.lens
        by_doc = lambda x: np.add.reduceat(x, starts)
        c = b.count[b.tokens]
        base = np.log10((c + 1) / (total + types + 1))
        each = {"token_scores": pa.ListArray.from_arrays(pa.array(np.append(starts, len(p)).astype(np.int32)), pa.array(np.log10(p)))} if with_tokens else {}
        return pa.table({
            "doc_id": left.column("docs").combine_chunks().flatten(), "held_out": pa.array(b.held), "n_tokens": b.lens, "n_known": by_doc((c > 0).astype(np.int64)),
            "train_tokens": np.full(len(b.lens), total, np.int64), "base_score": by_doc(base), "score": by_doc(np.log10(p)), **each,
        })

    free(docs.sparkSession)
    answers = one.filter("kind = 'r'").select("block", "bucket", "data", F.lit(1).alias("level")).unionByName(two.filter("kind = 'r'").select("block", "bucket", "data", F.lit(2).alias("level")))
    return corpus.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double" + ", token_scores array<double>" * with_tokens)

"""Sentence boundaries learned without labels (Kiss and Strunk 2006): abbreviations, collocations and frequent sentence starters by log-likelihood ratios over a corpus, and a splitter that uses them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the published method: from which score a word is an abbreviation, and from which ratio a pair is a collocation or a word a starter.
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
#: A model holds at most so many words or pairs of a kind, those of the highest scores: it goes to every task whole.
MOST = 100_000

_OPEN, _CLOSE = "[\"'(\\[{«“‘]", "[\"')\\]}»”’]"
_OPENING, _CLOSING = "\"'([{«“‘", "\"')]}»”’"


def tokens(texts: DataFrame, column: str = "text") -> DataFrame:
    """The different tokens of all texts, each with the token before it where a sentence may end there: type (lower-cased, without brackets, quotes and the final period), dot (a final
    period, no ellipsis), upper and lower (how it begins), first (nothing before it in the text), prev, prev_dot and prev_end (an ! or ?) of the token before, and n, how often that occurs.

    Tokens are counted as they stand, so that patterns run once for each different one, of which there are few.
    """
    bare = lambda w: F.regexp_replace(w, f"^{_OPEN}+|{_CLOSE}+$", "")
    dot = lambda w: w.endswith(".") & ~w.endswith("..")
    kind = lambda w: F.lower(F.regexp_replace(w, r"\.+$", ""))
    words = F.array_remove(F.split(F.coalesce(F.col(column), F.lit("")), r"\s+"), "")
    pairs_of = F.arrays_zip(F.col("w"), F.concat(F.array(F.lit(None).cast("string")), F.col("w")).alias("p"))
    # the closing pair has the last token as p, and no w
    at = texts.select(words.alias("w")).select(F.explode(pairs_of).alias("t")).select(F.col("t.w").alias("w"), F.col("t.p").alias("p")).filter("w is not null")
    ends = F.col("p").contains(".") | F.col("p").contains("!") | F.col("p").contains("?")
    seen = at.groupBy("w", F.col("p").isNull().alias("first"), F.when(ends, F.col("p")).alias("p")).agg(F.count("*").alias("n"))
    seen = seen.select(bare(F.col("w")).alias("w"), "first", bare(F.col("p")).alias("p"), "n")
    return seen.select(kind(F.col("w")).alias("type"), dot(F.col("w")).alias("dot"), F.col("w").rlike(r"^\p{Lu}").alias("upper"), F.col("w").rlike(r"^\p{Ll}").alias("lower"), "first", kind(F.col("p")).alias("prev"), F.coalesce(dot(F.col("p")), F.lit(False)).alias("prev_dot"), F.coalesce(F.col("p").rlike(r"[!?]$"), F.lit(False)).alias("prev_end"), "n")


def _sum_if(c: Column) -> Column:
    return F.sum(F.when(c, F.col("n")).otherwise(0))


def _xlog(n: Column, p: Column) -> Column:
    """n * ln(p), 0 where n is 0."""
    return F.when(n == 0, 0.0).otherwise(n * F.log(p))


def association(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio that two things with counts a and b, together ab times among n, go together."""
    p, p1, p2 = b / n, ab / a, F.try_divide(b - ab, n - a)
    both = lambda k, m, q: _xlog(k, q) + _xlog(m - k, 1 - q)
    inner = F.when((p2 <= 0) | (p2 >= 1) | p2.isNull(), 0.0).otherwise(both(b - ab, n - a, p2))
    return -2 * (both(ab, a, p) + both(b - ab, n - a, p) - F.when(a == ab, 0.0).otherwise(both(ab, a, p1)) - inner)


def counts(toks: DataFrame) -> DataFrame:
    """(type, with_dot, without, lower, upper_inside): how often a type occurs with a period, without, in small letters, and with a capital where no sentence can begin."""
    inside = F.col("upper") & ~F.col("first") & ~F.col("prev_dot") & ~F.col("prev_end")
    return toks.groupBy("type").agg(_sum_if(F.col("dot")).alias("with_dot"), _sum_if(~F.col("dot")).alias("without"), _sum_if(F.col("lower")).alias("lower"), _sum_if(inside).alias("upper_inside"))


def pairs(toks: DataFrame) -> DataFrame:
    """(prev, type, n, n_upper) of neighbours whose first ends with a period; prev is null after ! and ?."""
    after = toks.filter(F.col("prev_dot") | F.col("prev_end"))
    return after.groupBy(F.when(F.col("prev_dot"), F.col("prev")).alias("prev"), "type").agg(F.sum("n").alias("n"), _sum_if(F.col("upper")).alias("n_upper"))


def abbreviations(stats: DataFrame) -> DataFrame:
    """(type, score) of types that stand before a period far more often than words do, the more so the shorter they are and the more periods are inside."""
    total = stats.agg(F.sum(F.col("with_dot") + F.col("without")).alias("n"), F.sum("with_dot").alias("dots"))
    s = stats.filter("with_dot > 0").filter(F.col("type").rlike(r"^\p{L}[\p{L}.\-]*$")).join(F.broadcast(total))  # one row
    c, n, p = F.col("with_dot"), F.col("with_dot") + F.col("without"), F.col("dots") / F.col("n")
    ratio = -2 * (_xlog(c, p) + _xlog(n - c, 1 - p) - _xlog(c, F.lit(0.99)) - _xlog(n - c, F.lit(0.01)))
    inner = F.regexp_count("type", F.lit(r"\."))
    size = F.length("type") - inner
    score = ratio * F.exp(-size) * (inner + 1) * F.pow(size.cast("double"), -F.col("without").cast("double"))
    return s.select("type", score.alias("score")).filter(F.col("score") >= ABBREVIATION)


def _breaks(two: DataFrame, short: DataFrame) -> DataFrame:
    """Pairs whose first doesn't end with an abbreviation's period, nor a number's or an initial's."""
    plain = two.filter(F.col("prev").isNull() | ~F.col("prev").rlike(r"^(?:\p{Nd}+|\p{L})$"))
    return plain.join(short.select(F.col("type").alias("prev")), "prev", "left_anti")


def starters(stats: DataFrame, two: DataFrame, short: DataFrame) -> DataFrame:
    """(type, score) of words that begin sentences more often than chance has it."""
    at = _breaks(two, short).groupBy("type").agg(F.sum("n").alias("begins"))
    total = stats.agg(F.sum(F.col("with_dot") + F.col("without")).alias("n"))
    breaks = at.agg(F.sum("begins").alias("breaks"))
    s = at.filter(F.col("type").rlike(r"^\p{L}+$")).join(stats, "type").join(F.broadcast(total)).join(F.broadcast(breaks))  # one row each
    uses = F.col("with_dot") + F.col("without")
    score = association(F.col("breaks"), uses, F.col("begins"), F.col("n"))
    return s.filter(F.col("n") / F.col("breaks") > uses / F.col("begins")).select("type", score.alias("score")).filter(F.col("score") >= STARTER)


def collocations(stats: DataFrame, two: DataFrame, short: DataFrame) -> DataFrame:
    """(prev, type, score) of pairs over a period that belong together: the first an abbreviation, a number or an initial, seen twice or more."""
    total = stats.agg(F.sum(F.col("with_dot") + F.col("without")).alias("n"))
    uses = stats.select("type", (F.col("with_dot") + F.col("without")).alias("uses"))
    near = two.filter("n > 1").withColumnRenamed("n", "together")
    numbers = near.filter(F.col("prev").rlike(r"^(?:\p{Nd}+|\p{L})$"))
    near = near.join(short.select(F.col("type").alias("prev")), "prev", "left_semi").unionByName(numbers).distinct()
    s = near.join(uses, "type").join(uses.select(F.col("type").alias("prev"), F.col("uses").alias("prev_uses")), "prev").join(F.broadcast(total))  # one row
    score = association(F.col("prev_uses"), F.col("uses"), F.col("together"), F.col("n"))
    return s.filter(F.col("n") / F.col("prev_uses") > F.col("uses") / F.col("together")).select("prev", "type", score.alias("score")).filter(F.col("score") >= COLLOCATION)


@dataclass(frozen=True)
class Boundaries:
    """What was learned: abbreviations, starters, collocations, and words that are written small inside sentences only (after an abbreviation their capital shows a beginning)."""

    short: frozenset[str] = field(default_factory=frozenset)
    starters: frozenset[str] = field(default_factory=frozenset)
    together: frozenset[tuple[str, str]] = field(default_factory=frozenset)
    small: frozenset[str] = field(default_factory=frozenset)

    def breaks(self, word: str, after: str) -> bool:
        """Whether a sentence ends between two tokens of a text, the first with . ! or ? at its end."""
        bare, following = word.lstrip(_OPENING).rstrip(_CLOSING), after.lstrip(_OPENING)
        lower = following[:1].islower()
        if not bare.endswith(".") or bare.endswith(".."):
            return not lower
        one, two = bare.rstrip(".").lower(), following.rstrip(_CLOSING).rstrip(".").lower()
        if (one, two) in self.together:
            return False
        capital = following[:1].isupper()
        if one in self.short:
            return capital and (two in self.small or two in self.starters)
        if len(one) == 1 and one.isalpha():  # an initial
            return capital and two in self.small
        return not lower

    def split(self, text: str) -> list[str]:
        out, start = [], 0
        for m in _END.finditer(text):
            # the token before, 200 characters of it at most
            word, after = text[max(start, m.start() - 200, m.end(1) - 200) : m.end(1)].rsplit(None, 1)[-1], _NEXT.match(text, m.end())
            if after and self.breaks(word, after[0]):
                out.append(text[start : m.end(1)].strip())
                start = m.end()
        return [s for s in (*out, text[start:].strip()) if s]


_END = re.compile(r"([.!?][\"')\]}»”’]*)\s+")
_NEXT = re.compile(r"\S{1,200}")


def learn(texts: DataFrame, column: str = "text") -> Boundaries:
    """The boundaries of a corpus. All texts count, whole; the driver gets at most MOST words or pairs of each kind, those of the highest scores."""
    # all of the size of the vocabulary; texts are read once
    toks = tokens(texts, column).persist()
    stats, two = counts(toks).persist(), pairs(toks).persist()
    short = abbreviations(stats).persist()
    try:
        top = lambda df: df.orderBy(F.desc("score"), *[c for c in df.columns if c != "score"]).limit(MOST).collect()
        words = frozenset(r["type"] for r in top(short))
        begins = frozenset(r["type"] for r in top(starters(stats, two, short)))
        together = frozenset((r["prev"], r["type"]) for r in top(collocations(stats, two, short)))
        # ambiguous places only: words after an abbreviation or an initial
        after = two.filter(F.col("prev").rlike(r"^\p{L}$")).unionByName(two.join(short.select(F.col("type").alias("prev")), "prev", "left_semi").select(two.columns))
        small = after.groupBy("type").agg(F.sum("n").cast("double").alias("score")).join(stats.filter("lower > 0 and upper_inside = 0").select("type"), "type", "left_semi")
        return Boundaries(words, begins, together, frozenset(r["type"] for r in top(small)))
    finally:
        for t in (short, two, stats, toks):
            t.unpersist()


def sentences_trained(df: DataFrame, model: Boundaries, column: str = "text", name: str = "sentences") -> DataFrame:
    """Adds the text's sentences, as an array; none of a null or blank text. Texts are split where they lie: nothing is shuffled."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = pa.array([model.split(t or "") for t in b.column(at).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, cut], [*b.schema.names, name])

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{name}` array<string>")

"""Line dedup: winnowed line hashes, positions joined and extended both ways, later repeats deleted."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_spilled, row_key, spill, trim

#: A repeated passage has MIN_LINES lines in a row or is one line of MIN_WORDS words; with short_runs, any run of lines of MIN_WORDS words together.
MIN_LINES, MIN_WORDS = 3, 50
_GRAMS = "array<struct<at:int,lines:int,gram:binary>>"


def lines_of(text: str | None) -> tuple[list[str], list[int]]:
    """All \\n-split lines of a text (null: none), and the places of those with a word."""
    if text is None:
        return [], []
    lines = text.split("\n")
    return lines, [i for i, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r")]


def fingerprints(text: str | None, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, short_runs: bool = False) -> list[tuple[int, int, list[tuple[int, int, bytes]]]]:
    """Selected line hashes of a text: (hash, place, grams).

    In each window of min_lines lines the smallest hash is selected, the rightmost of equal ones. Which it is depends
    on the window's lines alone, so two equal windows anywhere select equal fingerprints: none is missed.
    grams: the windows that selected it, that is its context to the left and right, as (place of the first
    line, lines, digest of the lines). Lines of min_words words are windows of their own; with short_runs, so are runs of fewer than
    min_lines lines with min_words words together. Places count lines with a word.
    """
    lines, at = lines_of(text)
    full = [lines[i].encode() for i in at]
    hashes = [xxhash.xxh3_64_intdigest(x) for x in full]
    out: dict[int, list[tuple[int, int, bytes]]] = {}
    for i in range(len(full) - min_lines + 1):
        window = hashes[i : i + min_lines]
        low = min(window)
        best = i + max(k for k, h in enumerate(window) if h == low)
        out.setdefault(best, []).append((i, min_lines, xxhash.xxh3_128_digest(b"\n".join(full[i : i + min_lines]))))
    for i, x in enumerate(full):
        if len(x) >= 2 * min_words - 1 and len(x.split()) >= min_words:
            out.setdefault(i, []).append((i, 1, xxhash.xxh3_128_digest(x)))
    if short_runs:
        words = [len(x.split()) for x in full]
        for n in range(2, min_lines):
            for i in range(len(full) - n + 1):
                if sum(words[i : i + n]) >= min_words:
                    low = min(hashes[i : i + n])
                    best = i + max(k for k, h in enumerate(hashes[i : i + n]) if h == low)
                    out.setdefault(best, []).append((i, n, xxhash.xxh3_128_digest(b"\n".join(full[i : i + n]))))
    return [(hashes[i] - (1 << 63), i, grams) for i, grams in out.items()]


def cut_lines(text: str | None, spans: list[tuple[int, int]]) -> tuple[str | None, int, int, int]:
    """(text without the lines in spans, lines, lines removed, runs removed). A blank line goes with the line before it."""
    lines, at = lines_of(text)
    dead = bytearray(len(at))
    for a, n in spans:
        dead[a : a + n] = b"\1" * n
    gone = bytearray(len(lines))
    for k, i in enumerate(at):
        if dead[k]:
            to = at[k + 1] if k + 1 < len(at) else len(lines)
            gone[i:to] = b"\1" * (to - i)
    runs = sum(1 for k in range(len(at)) if dead[k] and not (k and dead[k - 1]))
    if not runs:
        return text, len(lines), 0, 0
    return "\n".join(x for x, g in zip(lines, gone, strict=True) if not g), len(lines), sum(gone), runs


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches in slices: what Python makes of a slice is freed before the next, and given back when the task ends, as workers live on."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    trim()


def dedup_lines(docs: DataFrame, keep: list[str] | None = None, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, short_runs: bool = False) -> DataFrame:
    """Delete later repeats of passages: (keep..., text, n_lines, n_removed, n_runs), one row for each row.

    A line goes if it lies in a passage (min_lines lines in a row, or one line of min_words words, or, with short_runs, any run of
    lines of min_words words together) that occurs at an
    earlier (doc_id, place), the same document included. Runs of any length are unions of such passages: the
    windows around each joined fingerprint overlap to both sides. Blank lines don't count as lines; one goes if
    the line before it goes. Passages are judged on the input, not on what is left. Null texts stay null, empty ones
    empty; a document may end empty. A null doc_id comes before all others. Rows that repeat doc_id and text are the same document:
    they are treated alike and don't delete each other. An empty table gives an empty result. Texts and lines of any length are read whole; columns
    but doc_id, text and those in keep are not read, and keep can't hold names of the result but text.
    """
    keep = list(keep or ["doc_id"])
    # what stands for a row in joins
    docs = docs.select(*keep, *[c for c in ("doc_id", "text") if c not in keep]).withColumn("__key", row_key("doc_id", "text"))
    src = docs.select("doc_id", "__key", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_type = pa.list_(pa.struct([("at", pa.int32()), ("lines", pa.int32()), ("gram", pa.binary())]))
        for b in sliced(batches):
            rows, hs, grams = [], [], []
            for r, text in enumerate(b.column(2).to_pylist()):
                for h, _, g in fingerprints(text, min_lines, min_words, short_runs):
                    rows.append(r)
                    hs.append(h)
                    grams.append([{"at": a, "lines": n, "gram": d} for a, n, d in g])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(hs, pa.int64()), pa.array(grams, grams_type)], ["doc_id", "__key", "h", "grams"])

    marks = spill(src.mapInArrow(select, f"doc_id {id_type}, __key binary, h long, grams {_GRAMS}"), "lines-marks")
    again = spill(marks.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "lines-again")
    spots = marks.join(again.hint("merge"), "h").select("doc_id", "__key", F.explode("grams").alias("g"))
    spots = spill(spots.select("doc_id", "__key", "g.at", "g.lines", "g.gram"), "lines-spots")
    place = F.struct("doc_id", "__key", "at")
    first = spill(spots.groupBy("gram").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "lines-first")
    later = spots.join(first.hint("merge"), "gram").filter(~place.eqNullSafe(F.col("first")))
    spans = later.groupBy("__key").agg(F.collect_set(F.struct("at", "lines")).alias("__spans"))  # of one document
    spans = spill(spans, "lines-spans")
    drop_spilled(marks, again, spots, first)
    joined = docs.join(spans.hint("merge"), "__key", "left").select(*keep, *[F.col("text").alias("__text")], "__spans")
    names = [c for c in keep if c != "text"]
    joined = joined.select(*names, "__text", "__spans")
    k = len(names)
    # merge joins at every size: a broadcast where the right side happens to be small would hide what a large input costs

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts, spans = b.column(k).to_pylist(), b.column(k + 1).to_pylist()
            got = [cut_lines(t, [(x["at"], x["lines"]) for x in s or ()]) for t, s in zip(texts, spans, strict=True)]
            cols = list(zip(*got, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])], [*names, "text", "n_lines", "n_removed", "n_runs"])

    head = "".join(f"`{c}` {joined.schema[c].dataType.simpleString()}, " for c in names)
    return joined.mapInArrow(cut, f"{head}text string, n_lines long, n_removed long, n_runs long")

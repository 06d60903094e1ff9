"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, spill

#: Bits of the seeded hash that deal a source's documents into cells; only one cell of a source is ever sorted.
CELL_BITS = 12


def word_count(text: str = "text"):
    return F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(F.col(text), F.lit(WORD))).cast("long")


def fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """Capped water-filling over rows (source, source_size, weight): adds target.

    All sizes together are shared out by weight; a source above max_epochs times its size is clamped there and
    its excess goes to the others by weight, again until none is above. So targets are min(level * weight, cap), and the level rises
    from round to round, each of which clamps another source at least; a round is one sum over the sources. One row per source.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total, weight = sources.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    level = total / weight if weight else 0.0
    while weight:
        full = F.col("weight") * F.lit(level) > cap
        held, free = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        new = (total - held) / free if free else level
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def numbered(sources: DataFrame) -> DataFrame:
    """Adds nth, from 0 by code point, null last: rows are sorted over the tasks, and a task's first number is the count of those before it."""
    placed = spill(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("__task", F.spark_partition_id()), "mix-order", tidy=False)
    counts = placed.groupBy("__task").agg(F.count("*").alias("n"))  # a row for each task of the sort
    first = counts.select("__task", (F.sum("n").over(Window.orderBy("__task")) - F.col("n")).alias("first"))
    own = F.row_number().over(Window.partitionBy("__task").orderBy(F.col("source").asc_nulls_last())) - 1
    return placed.withColumn("own", own).join(first, "__task").withColumn("nth", F.col("first") + F.col("own")).drop("__task", "own", "first")


def _shares(docs: DataFrame, keep: list[str], seed: int = 7, max_epochs: float = 3.0, weights=(1.0, 2.0, 3.0)) -> tuple[DataFrame, DataFrame]:
    """Rows with size, source_size, target, repeats, part, again: those outside their source's cut cell, and those in it."""
    # 60 bits of a digest that SQL has too
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))), 1, 15), 16, 10).cast("long")
    rows = docs.select(*keep, F.col("doc_id").alias("__id"), F.col("source").alias("__source"), h.alias("__h"), word_count().alias("size"))
    rows = rows.withColumn("__cell", F.shiftrightunsigned("__h", 60 - CELL_BITS).cast("int"))
    if "text" not in keep:
        rows = spill(rows, "mix-sizes")
    base = rows.select(F.col("__source").alias("source"), F.col("__cell").alias("cell"), "size")
    by_cell = spill(base.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"), F.count("*").alias("n")), "mix-cells")
    sources = by_cell.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    sources = numbered(sources)
    sources = sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights)).cast("int")))
    sources = spill(sources, "mix-sources", tidy=False)
    plan = spill(fill(sources, max_epochs), "mix-plan", tidy=False)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.select(F.col("source").alias("s"), "source_size", "target", F.floor(ratio).cast("long").alias("repeats"))
    plan = plan.withColumn("cut", F.floor(F.col("target") - F.col("repeats") * F.col("source_size")).cast("long"))
    # the cell of each source in which the cut falls, and how many words of it are still taken
    running = F.coalesce(F.sum("cell_size").over(Window.partitionBy("s").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = by_cell.join(plan, by_cell["source"].eqNullSafe(plan["s"])).withColumn("room", F.col("cut") - running)
    cells = cells.filter("room >= 0 and room < cell_size").select(F.col("s").alias("__s"), F.col("cell").alias("cut_cell"), "room")
    plan = spill(plan.join(cells, plan["s"].eqNullSafe(cells["__s"]), "left").select("s", "source_size", "target", "repeats", F.coalesce("cut_cell", F.lit(-1)).alias("cut_cell"), "room"), "mix-cut", tidy=False)
    # one row for each source: Spark broadcasts it while it is small, and else splits the large sources of a merge join
    j = rows.join(plan, F.col("__source").eqNullSafe(F.col("s"))).drop("s")
    whole = j.filter("__cell <> cut_cell").withColumn("part", F.when(F.col("__cell") < F.col("cut_cell"), F.col("size")).otherwise(0).cast("long"))
    whole = whole.withColumn("again", (F.col("__cell") < F.col("cut_cell")).cast("int"))
    cut = j.filter("__cell = cut_cell")
    pos = F.sum("size").over(Window.partitionBy("__source").orderBy("__h", "__id", "size").rowsBetween(Window.unboundedPreceding, -1))
    cut = cut.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.coalesce(pos, F.lit(0)))).cast("long"))
    cut = cut.withColumn("again", ((F.col("part") == F.col("size")) & (F.col("size") > 0)).cast("int"))
    return whole, cut


def mix(docs: DataFrame, keep: list[str] | None = None, **options) -> DataFrame:
    """How often each document is taken: (keep..., size, source_size, target, repeats, part, taken).

    Size: words of the text (null: 0). Sources, by code point and null last, weigh 1, 2, 3, repeating.
    Each document is taken floor(target / source_size) whole times. For the fraction left, the documents
    of a source stand in the order of a seeded hash of (doc_id, text): those before the cut are taken once more, the one
    on the cut with as many of its words as are missing (`part`). So a source's taken words are its target
    rounded down, and no document exceeds max_epochs times its size when that is whole. A document without a word is
    taken as often as others, for no words.

    Null sources are a source of their own. Rows that repeat (doc_id, text) stand next to each other in the order, each
    counting by itself. An empty table gives an empty result. The result depends on the rows and the seed only. Texts of any length are read
    whole; of other columns only those in keep are read, which can't have names of the result.

    A source's order is not sorted as a whole: its documents fall into 2**12 cells by the hash's first
    bits, sizes are summed by (source, cell), and only the cell that holds the cut is sorted. Texts are not shuffled.
    """
    keep = list(keep or ["doc_id"])
    whole, cut = _shares(docs, keep, **options)
    taken = (F.col("repeats") * F.col("size") + F.col("part")).alias("taken")
    return whole.unionByName(cut).select(*keep, "size", "source_size", "target", "repeats", "part", taken)


def first_words(text: str, n: int) -> str:
    """The text up to the end of its n-th word."""
    end = 0
    for k, m in enumerate(re.finditer(WORD, text), 1):
        end = m.end()
        if k == n:
            break
    return text[:end]


def mixed_documents(docs: DataFrame, keep: list[str], **options) -> DataFrame:
    """The mix itself: rows keep... (doc_id, text, source among them) as often as they are taken; a partial repetition is the first words of the text.

    At most one document of a source is taken in part.
    """
    whole, cut_rows = _shares(docs, keep, **options)
    names = [*keep, "repeats", "again"]
    rows = whole.select(names).unionByName(cut_rows.select(names))
    copies = rows.withColumn("__n", (F.col("repeats") + F.col("again")).cast("int")).filter("__n > 0")
    copies = copies.select(*keep, F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*keep)
    part = cut_rows.filter("part > 0 and part < size").select(*keep, "part")
    at, k = keep.index("text"), len(keep)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = b.columns[:k]
            cols[at] = pa.array([first_words(t, n) for t, n in zip(b.column(at).to_pylist(), b.column(k).to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(cols, keep)

    head = ", ".join(f"`{c}` {part.schema[c].dataType.simpleString()}" for c in keep)
    return copies.unionByName(part.mapInArrow(cut, head))

"""Incremental runs: what is done already is left out by anti-joins against state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unprocessed(rows: DataFrame, state: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Rows whose keys aren't in the state, or all of them."""
    return rows if force else rows.join(state.select(*keys), keys, "left_anti")


def by_content(rows: DataFrame, done: DataFrame, content: str, force: bool = False) -> DataFrame:
    """Rows with their content's hash, without those whose hash is done; done: doc_hash."""
    return unprocessed(rows.withColumn("doc_hash", F.sha2(F.col(content), 256)), done, ["doc_hash"], force)


def state_update(state: DataFrame, new: DataFrame) -> DataFrame:
    return state.unionByName(new.select(state.columns)).distinct()


def dedupe_priority(files: DataFrame) -> DataFrame:
    """One file for each base name: a PDF where there is one, else the first by path. files: base, ext, path."""
    w = Window.partitionBy("base").orderBy(F.desc(F.col("ext") == ".pdf"), "path")
    return files.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def part_number(page: Column, pages: int) -> Column:
    return F.floor((page - 1) / pages).cast("int") + 1


def head_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first n lines of each file; lines: file, line_no."""
    w = Window.partitionBy("file").orderBy("line_no")
    return lines.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")

"""Evaluation of labels: joins, report, confusion counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_labels(golden: DataFrame, predicted: DataFrame) -> DataFrame:
    """(file, truth, guess) of files that both sides label; both: file, label."""
    return golden.select("file", F.col("label").alias("truth")).join(predicted.select("file", F.col("label").alias("guess")), "file")


def labels(pairs: DataFrame) -> DataFrame:
    """(label) of either side, each once, in order."""
    return pairs.select(F.col("truth").alias("label")).union(pairs.select("guess")).distinct().orderBy("label")


def confusion(pairs: DataFrame, most: int = 1000) -> DataFrame:
    """(truth, guess, n) over all pairs of labels that occur on either side, zeros included. A matrix: rows are counted first, and over `most` labels are an error."""
    n = pairs.groupBy("truth", "guess").agg(F.count("*").alias("n"))
    known = n.select(F.col("truth").alias("label")).union(n.select("guess")).distinct()
    if known.limit(most + 1).count() > most:
        raise ValueError(f"over {most} labels: no matrix of them")
    every = known.agg(F.collect_set("label").alias("ls")).select(F.explode("ls").alias("truth"), "ls").select("truth", F.explode("ls").alias("guess"))
    return every.join(n, ["truth", "guess"], "left").na.fill(0, ["n"])


def report(pairs: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) of each label, then accuracy, macro and weighted means; what has no cases is 0."""
    c = confusion(pairs)
    hit = F.sum(F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0))
    t = c.groupBy(F.col("truth").alias("label")).agg(hit.alias("tp"), F.sum("n").alias("support"))
    g = c.groupBy(F.col("guess").alias("label")).agg(F.sum("n").alias("guessed"))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    p, r = zero(F.try_divide(F.col("tp"), F.col("guessed"))), zero(F.try_divide(F.col("tp"), F.col("support")))
    per = t.join(g, "label").select("label", p.alias("precision"), r.alias("recall"), "support", "tp")
    per = per.withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))
    scores = ("precision", "recall", "f1")
    macro = per.agg(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores], F.sum("support").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("label"), *[zero(F.try_divide(F.sum(F.col(s) * F.col("support")), F.sum("support"))).alias(s) for s in scores], F.sum("support").alias("support"))
    acc = zero(F.try_divide(F.sum("tp"), F.sum("support")))
    accuracy = per.agg(F.lit("accuracy").alias("label"), *[acc.alias(s) for s in scores], F.sum("support").alias("support"))
    names = ["label", *scores, "support"]
    return per.select(names).unionByName(accuracy.select(names)).unionByName(macro.select(names)).unionByName(weighted.select(names))

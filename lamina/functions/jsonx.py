"""JSON out of model answers: fences, outer braces, the first object that parses, fallbacks, repair."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .jsonrepair import mend

#: Fixed values.
FENCE = r"(?s)```(?:json)?\s*(\{.*?\}|\[.*?\])\s*```"
MANUAL = "manual_review_required"


def fenced(c: Column) -> Column:
    """The JSON in a code fence, else from the first to the last brace, else the text."""
    outer = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    return F.when(c.rlike(FENCE), F.trim(F.regexp_extract(c, FENCE, 1))).when(outer != "", outer).otherwise(c)


def is_json(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def or_fallback(c: Column) -> Column:
    """struct(summary, tags, classification): an answer's own where it is JSON, else the raw text for manual review."""
    schema = "summary string, tags array<string>, classification string"
    raw = F.struct(F.regexp_replace(c, r"(?U)^\s+|\s+$", "").alias("summary"), F.array().cast("array<string>").alias("tags"), F.lit(MANUAL).alias("classification"))
    return F.when(is_json(c), F.from_json(c, schema)).otherwise(raw)


def first_object(text: str | None) -> str | None:
    """The first run of balanced braces that is JSON; braces in strings count, as they do not close what they open."""
    depth, start = 0, -1
    for m in re.finditer(r"[{}]", text or ""):
        if m[0] == "{":
            start, depth = (m.start() if start < 0 else start), depth + 1
        elif start >= 0:
            depth -= 1
            if not depth:
                part = text[start : m.end()]
                try:
                    json.loads(part)
                    return part
                except ValueError:
                    start = -1
    return None


def repair(text: str | None) -> str | None:
    """JSON of a text that nearly is (jsonrepair.mend()), else the first object in it that parses, else None."""
    return mend(text) or first_object(text)


def repair_stage(df: DataFrame, column: str) -> DataFrame:
    """Adds stage: 'strict' where the column is JSON, 'repaired' where mending made it so, else 'failed'. Python sees the failing rows only."""
    good = df.filter(is_json(F.col(column))).withColumn("stage", F.lit("strict"))
    bad = df.filter(~F.coalesce(is_json(F.col(column)), F.lit(False)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fixed = b[column].map(repair)
            yield b.assign(**{column: fixed.where(fixed.notna(), b[column]), "stage": fixed.notna().map({True: "repaired", False: "failed"})})

    mended = bad.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", stage string")
    return good.unionByName(mended)

"""Dates from texts, paths, names and ids; what can't be read is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
CONTENT = r"(?i)(?:Published on|Effective Date|Date|Revision):\s*(\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{4}[-/]\d{1,2}[-/]\d{1,2}|[A-Za-z]+\s\d{1,2},\s\d{4})"
ISO = r"(\d{4}-\d{2}-\d{2})"
CONFIDENCE = {"content": 1.0, "path": 0.7, "filename": 0.8, "filesystem_modified": 0.5}


def lenient_date(c: Column) -> Column:
    """Numeric dates month first, then day first; ISO dates; 'Month d, yyyy' and 'd Month yyyy' with long or short names."""
    c = F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"(?i)\bSept\b", "Sep")
    slashed = F.replace(c, F.lit("-"), F.lit("/"))
    plain = ["M/d/yyyy", "d/M/yyyy", "M/d/yy", "yyyy/M/d"]
    wordy = ["MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy"]
    year4 = slashed.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$|^\d{4}/\d{1,2}/\d{1,2}$")
    year2 = slashed.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$")
    tries = [F.when(year2 if f.endswith("/yy") else year4, F.to_date(F.try_to_timestamp(slashed, F.lit(f)))) for f in plain]
    named = c.rlike(r"^[A-Za-z]+ \d{1,2}, \d{4}$|^\d{1,2} [A-Za-z]+ \d{4}$")
    tries += [F.when(named, F.to_date(F.try_to_timestamp(F.initcap(c), F.lit(f)))) for f in wordy]
    return F.coalesce(*tries)


def date_hierarchy(text: Column, directory: Column, name: Column, modified: Column) -> tuple[Column, Column, Column]:
    """(date, source, confidence): the text's own date, else that in the directory, the file name, the time of change."""
    pick = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    found = [("content", lenient_date(pick(text, CONTENT))), ("path", F.to_date(F.try_to_timestamp(pick(directory, ISO), F.lit("yyyy-MM-dd")))), ("filename", F.to_date(F.try_to_timestamp(pick(name, ISO), F.lit("yyyy-MM-dd")))), ("filesystem_modified", F.to_date(modified))]
    source = F.coalesce(*[F.when(d.isNotNull(), F.lit(s)) for s, d in found], F.lit("none"))
    confidence = F.coalesce(*[F.when(d.isNotNull(), F.lit(CONFIDENCE[s])) for s, d in found], F.lit(0.0))
    return F.coalesce(*[d for _, d in found]), source, confidence


def docid_date(c: Column) -> tuple[Column, Column]:
    """(date, source) from an id: month and year, month's name and year, a year from 2000, else 1970-01-01."""
    first = lambda p, k: F.nullif(F.regexp_extract(c, p, k), F.lit(""))
    n = r"(\d{1,2})-(\d{4})"
    w = r"([a-zA-Z]{3,})-(\d{4})"
    number = F.to_date(F.try_to_timestamp(F.concat_ws("-", first(n, 1), first(n, 2)), F.lit("M-yyyy")))
    word = F.concat_ws("-", F.initcap(first(w, 1)), first(w, 2))
    short, long = (F.to_date(F.try_to_timestamp(word, F.lit(f"{m}-yyyy"))) for m in ("MMM", "MMMM"))
    year = F.to_date(F.try_to_timestamp(first(r"\b(20\d{2})\b", 1), F.lit("yyyy")))
    day = F.coalesce(number, short, long, year, F.lit("1970-01-01").cast("date"))
    return day, F.when(F.year(day) == 1970, "default_fallback").otherwise("derived_from_filename")


def iso_or_default(c: Column, default: str = "1970-01-01") -> Column:
    """A timestamp in ISO form, a date or a date with a time; else the default day."""
    iso = c.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$")
    return F.coalesce(F.when(iso, F.try_to_timestamp(F.replace(c, F.lit("T"), F.lit(" ")))), F.lit(default).cast("timestamp"))

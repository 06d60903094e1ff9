"""Predicates over text, blocks and tables, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import alnum_count, bound, count_of, strip

#: Fixed values.
NOT_DATA = ("foreword", "contents", "table of contents", "record of updates", "abbreviations and acronyms")
MARGIN = r"(?i)Guidelines for preparing a submission to the PBAC, Version \d+\.\d+, September \d+|^Flowchart \d+\.\d+\s+Overview of|^Figure \d+\.\d+"
CAPTION = r"(?i)^(Table|Figure|Flowchart) \d+\.?\d*(\.?\d*)?\s+"
COMPANY = r"(?i)(?:PTY LTD|LIMITED|INC|CORP|PHARMACEUTICAL|DRUG|MEDICINE|PRODUCT)\b"


def low_value(c: Column) -> Column:
    """Under 20 characters when stripped, or under half of them letters or digits."""
    t = strip(c)
    return (F.length(t) < 20) | (F.try_divide(alnum_count(t), F.length(t)) < 0.5)


def is_header(c: Column) -> Column:
    """Could be a heading: not blank, long, a bullet, a table row, a number or a roman numeral, and with an ASCII letter."""
    t = strip(c)
    return (
        (F.length(t) > 0)
        & (F.length(t) <= 300)
        & ~t.rlike(r"(?U)^(?:[•*-]\s|o )")
        & (count_of(t, r"\|") < 3)
        & ~t.rlike(r"^\p{Nd}+$")
        & ~((F.length(t) <= 3) & ~t.rlike("[a-zA-Z]"))
        & ~F.lower(t).rlike("^[ivx]+$")
        & t.rlike("[a-zA-Z]")
    )


def noncontent_reason(text: Column, page: Column, y0: Column, y1: Column, height: Column, repeated: Column) -> Column:
    """Why a text block isn't content, null if it is: the first rule that applies."""
    margin = (height - y1 < 100) | (y0 < 100)

    def reason(t: Column) -> Column:
        n = F.length(t)
        number = t.rlike(r"^\p{Nd}+$") | t.rlike(r"(?i)^\p{Nd}+\s+of\s+\p{Nd}+$") | t.rlike("^[ivxIVX]+$")
        title = t.rlike(COMPANY) | ((n > 15) & (F.try_divide(count_of(t, r"\p{Lu}"), n) > 0.7)) | t.rlike(r"^\s*\(?[\p{L}\p{N}_]+\s+([A-Z\s]+)\)?$")
        return (
            F.when(n == 0, "blank")
            .when(repeated, "repeated")
            .when((n < 15) & number, "page_number")
            .when((n <= 3) & ~t.rlike(r"[\p{L}\p{N}]"), "noise")
            .when(margin & (n > 30) & t.rlike(MARGIN), "margin")
            .when((n < 300) & t.rlike(CAPTION), "caption")
            .when((page <= 5) & (y0 < height * 0.3) & (n > 10) & (n < 150) & title, "title")
        )

    return bound(strip(text), reason)


def is_data_table(markdown: Column) -> Column:
    """A table of data and not of layout, by keywords, share of rows with three pipes, and letters to a pipe."""
    lines = F.filter(F.split(strip(markdown), "\n"), lambda x: ~x.startswith("|---") & (F.length(strip(x)) > 5))
    n = F.size(lines)
    rows = F.size(F.filter(lines, lambda x: count_of(x, r"\|") >= 3))
    pipes = count_of(markdown, r"\|")
    thin = (n > 0) & ((F.try_divide(rows, n) < 0.2) | ((n < 3) & (rows < 2)))
    wordy = (pipes > 0) & (F.try_divide(alnum_count(markdown), pipes) > 50)
    return (F.length(markdown) > 0) & ~F.lower(markdown).rlike("|".join(NOT_DATA)) & ~thin & ~F.coalesce(wordy, F.lit(False))

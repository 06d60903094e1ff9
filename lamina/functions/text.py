"""Text functions as Column expressions. White space is Unicode's where the rules strip it, as in Python."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

#: Fixed values.
BOILERPLATE = r"(?i)(Confidential|PBAC Public Summary Document|Page \d+ of \d+)"
PAGE_MARKER = r"\n\s*--- Page \d+ ---\s*\n"
ABBREVIATIONS = ("Dr", "Mr", "Mrs", "Ms", "Prof", "St", "vs", "etc", "Fig", "No")
UNTITLED = "Untitled Document"


def strip(c: Column) -> Column:
    # one greedy match: a search for trailing white space would stop at every blank
    return F.regexp_extract(c, r"(?Us)^\s*(.*\S)?", 1)


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, where c is computed once: as the only element of an array. Named several times in an expression it would be computed as often."""
    return F.transform(F.array(c), f)[0]


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def alnum_count(c: Column) -> Column:
    # runs removed and the rest measured: a third of the time of counting matches
    return F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))


def normalize_text(c: Column) -> Column:
    """Line ends, blank lines, blanks, page markers and boilerplate, in this order; then stripped. Most texts have few of them: a plain search comes before each costly replacement."""
    def rule(c: Column, there: Callable[[Column], Column], pattern: str, to: str) -> Column:
        return bound(c, lambda x: F.when(there(x), F.regexp_replace(x, pattern, to)).otherwise(x))

    c = rule(c, lambda x: x.contains("\r"), r"\r\n|\r", "\n")
    c = rule(c, lambda x: x.contains("\n\n\n"), r"\n{3,}", "\n\n")
    c = rule(c, lambda x: x.contains("\t") | x.contains("  "), r"[ \t]+", " ")
    c = rule(c, lambda x: x.contains("--- Page "), PAGE_MARKER, "\n")
    c = rule(c, lambda x: bound(F.lower(x), lambda y: y.contains("confidential") | y.contains("pbac public summary document") | (y.contains("page ") & y.contains(" of "))), BOILERPLATE, "")
    edge = r"(?U)^\s"
    return bound(c, lambda x: F.when(F.left(x, F.lit(1)).rlike(edge) | F.right(x, F.lit(1)).rlike(edge), strip(x)).otherwise(x))


def markdown_headings(c: Column) -> Column:
    """Lines in capitals become headings; the others are stripped."""
    def line(x: Column) -> Column:
        s = strip(x)
        return F.when(s.rlike(r"\p{Lu}") & ~s.rlike(r"[\p{Ll}\p{Lt}]"), F.concat(F.lit("## "), s)).otherwise(s)

    return F.array_join(F.transform(F.split(c, "\n"), line), "\n")


def title_guess(c: Column) -> Column:
    """The first line that isn't blank, if it has 15 words or fewer; else the next such line."""
    lines = F.transform(F.split(c, "\n"), strip)
    fit = F.filter(lines, lambda x: (F.length(x) > 0) & (count_of(x, r"\S+") <= 15))
    return F.coalesce(F.get(fit, F.lit(0)), F.lit(UNTITLED))


def chunk_type_snake(c: Column) -> Column:
    """CamelCase and spaced purposes in snake case; one pass over double underscores, apostrophes stay."""
    c = F.regexp_replace(c, "(.)([A-Z][a-z]+)", "$1_$2")
    c = F.lower(F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1_$2"))
    return F.replace(F.replace(F.replace(c, F.lit("/"), F.lit("_")), F.lit(" "), F.lit("_")), F.lit("__"), F.lit("_"))


def clean_path(path: Column) -> Column:
    """A path without elements that repeat the one before."""
    return F.filter(path, lambda x, i: (i == 0) | (x != F.get(path, i - 1)))


def word_windows(c: Column, size: int, overlap: int) -> Column:
    """Windows of `size` words, each starting size - overlap after the last; the last one may lie within its predecessor."""
    if not 0 <= overlap < size:
        raise ValueError("0 <= overlap < size is needed, else windows never advance")
    def cut(words: Column) -> Column:
        starts = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1, F.lit(size - overlap))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, F.lit(size)), " "))

    # the words bound once, as the only element of an array: named in the inner function they would be cut anew for each window
    return F.transform(F.array(F.filter(F.split(c, r"\s+"), lambda w: w != "")), cut)[0]


def sentences(c: Column) -> Column:
    """Sentences by rule: a terminator, white space, and no small letter after it; not after usual abbreviations."""
    c = F.regexp_replace(c, rf"(^|[\s(])({'|'.join(ABBREVIATIONS)})\.(\s)", "$1$2\u0002$3")
    c = F.regexp_replace(c, r"([.!?][\"')\]]*)\s+([^\s\p{Ll}])", "$1\u0001$2")
    c = F.replace(c, F.lit("\u0002"), F.lit("."))
    return F.filter(F.transform(F.split(c, "\u0001"), strip), lambda s: s != "")


def sentence_chunks(parts: Column, size: int | Column, overlap: int | Column) -> Column:
    """Sentences packed greedily: a chunk closes when the next would exceed `size`; the next starts with the last
    sentences that stay under `overlap`. A longer sentence is a chunk of its own."""
    size, overlap = (F.lit(x) if isinstance(x, int) else x for x in (size, overlap))
    empty = F.array().cast("array<string>")
    # width: characters of the open chunk, one blank between sentences; carried along, so that a sentence costs the same anywhere
    start = F.struct(empty.alias("done"), empty.alias("cur"), F.lit(0).alias("width"))

    def tail(cur: Column) -> Column:
        # how many last sentences fit, and their width: the longest suffix with sum(length + 1) < overlap
        return F.aggregate(
            F.reverse(cur),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("len"), F.lit(True).alias("on")),
            lambda a, s: F.transform(
                F.array(a["on"] & (a["len"] + F.length(s) + 1 < overlap)),
                lambda fits: F.struct(F.when(fits, a["n"] + 1).otherwise(a["n"]).alias("n"), F.when(fits, a["len"] + F.length(s) + 1).otherwise(a["len"]).alias("len"), fits.alias("on")),
            )[0],
        )

    def step(a: Column, s: Column) -> Column:
        full = (a["width"] + F.length(s) + 1 > size) & (F.size(a["cur"]) > 0)
        longer = F.struct(a["done"].alias("done"), F.concat(a["cur"], F.array(s)).alias("cur"), (a["width"] + F.length(s) + F.when(F.size(a["cur"]) > 0, 1).otherwise(0)).alias("width"))
        closed = F.transform(
            F.array(tail(a["cur"])),
            lambda t: F.struct(
                F.concat(a["done"], F.array(F.array_join(a["cur"], " "))).alias("done"),
                F.concat(F.slice(a["cur"], F.size(a["cur"]) - t["n"] + 1, t["n"]), F.array(s)).alias("cur"),
                (t["len"] + F.length(s)).alias("width"),
            ),
        )[0]
        return F.when(full, closed).otherwise(longer)

    end = lambda a: F.when(F.size(a["cur"]) > 0, F.concat(a["done"], F.array(F.array_join(a["cur"], " ")))).otherwise(a["done"])
    return F.aggregate(parts, start, step, end)


def trim_all(c: Column, kind: DataType) -> Column:
    """A column of this type with every string in it stripped, at any depth; map keys stay."""
    if isinstance(kind, StringType):
        return strip(c)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: trim_all(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(c, lambda _, v: trim_all(v, kind.valueType))
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*[trim_all(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def trim_table(df: DataFrame) -> DataFrame:
    return df.select(*[trim_all(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def adaptive_size(path: Column, rules: list[dict], default: tuple[int, int]) -> tuple[Column, Column]:
    """(chunk size, overlap) of the first rule with a keyword somewhere in the lower-cased path."""
    text = F.lower(F.array_join(path, " "))
    size = over = None
    for r in rules:
        hit = text.rlike("|".join(r["keywords"]))
        size = F.when(hit, r["chunk_size"]) if size is None else size.when(hit, r["chunk_size"])
        over = F.when(hit, r["overlap"]) if over is None else over.when(hit, r["overlap"])
    return size.otherwise(default[0]), over.otherwise(default[1])


def parse_page_name(c: Column) -> tuple[Column, Column]:
    """(document, page) of names like <document>_page_<n>.json; else Unknown and null."""
    p = r"^(.+)_page_(\d+)\.json"
    hit = c.rlike(p)
    return F.when(hit, F.regexp_extract(c, p, 1)).otherwise("Unknown"), F.when(hit, F.regexp_extract(c, p, 2).cast("int"))

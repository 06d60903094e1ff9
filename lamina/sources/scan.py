"""Sources: folders of files as tables, text by format, JSON artifacts, inventories."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .pdf import pdf_text

SUPPORTED = (".pdf", ".docx", ".txt", ".md")


def file_parts(path: Column) -> dict[str, Column]:
    """name, stem and extension (lower case, with the dot) of a path; URL marks are decoded."""
    name = F.url_decode(F.replace(F.regexp_extract(path, r"([^/]+)$", 1), F.lit("+"), F.lit("%2B")))
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return {"name": name, "stem": F.regexp_replace(name, r"\.[^.]*$", ""), "ext": ext}


def files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """All files under a folder: path, modificationTime, length, content (read only where it is asked for), name, stem, ext."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    df = (r.option("pathGlobFilter", pattern) if pattern else r).load(root)
    return df.withColumns(file_parts(F.col("path")))


def supported(spark: SparkSession, root: str, formats=SUPPORTED) -> DataFrame:
    return files(spark, root).filter(F.col("ext").isin(*formats))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(file_name, relative_path, size_kb, extension, modified_at); contents are not read."""
    base = re.sub(r"^file:/*|/+$", "", root).lstrip("/")
    rel = F.regexp_replace(F.regexp_replace("path", r"^file:/+", ""), "^" + re.escape(base) + "/", "")
    return files(spark, root).select(F.col("name").alias("file_name"), rel.alias("relative_path"), F.round(F.col("length") / 1024, 2).alias("size_kb"), F.col("ext").alias("extension"), F.col("modificationTime").alias("modified_at"))


def docx_text(content: bytes) -> str:
    """The paragraphs of a word-processor file, one a line."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter(f"{w}t")) for p in root.iter(f"{w}p"))


def xlsx_text(content: bytes) -> str:
    """The cells of all sheets of a spreadsheet, a row a line."""
    m = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{m}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{m}si")]
        out = []
        for name in sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
            for row in ElementTree.fromstring(z.read(name)).iter(f"{m}row"):
                cells = []
                for c in row.iter(f"{m}c"):
                    v = c.find(f"{m}v")
                    text = "".join(t.text or "" for t in c.iter(f"{m}t")) if v is None else v.text or ""
                    cells.append(shared[int(text)] if c.get("t") == "s" else text)
                out.append(" ".join(cells))
    return "\n".join(out)


READERS = {".docx": docx_text, ".xlsx": xlsx_text, ".pdf": pdf_text}


def texts(df: DataFrame, readers=None) -> tuple[DataFrame, DataFrame]:
    """(path, text) of readable files, and the quarantine (path, error): unknown formats and files that a reader rejects.

    Plain text is decoded in the JVM, with what isn't UTF-8 replaced; Python sees only the other formats.
    """
    readers = readers or READERS
    plain = df.filter(F.col("ext").isin(".txt", ".md")).select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"), F.lit(None).cast("string").alias("error"))
    unknown = df.filter(~F.col("ext").isin(".txt", ".md", *readers)).select("path", F.lit(None).cast("string").alias("text"), F.concat(F.lit("unsupported format "), "ext").alias("error"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, ext, content in zip(b["path"], b["ext"], b["content"], strict=True):
                try:
                    rows.append((path, readers[ext](bytes(content)), None))
                except Exception as e:  # noqa: BLE001  errors are data here
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "text", "error"])

    other = df.filter(F.col("ext").isin(*readers)).select("path", "ext", "content").mapInPandas(read, "path string, text string, error string")
    every = plain.unionByName(other).unionByName(unknown)
    return every.filter("error is null").select("path", "text"), every.filter("error is not null").select("path", "error")


def json_files(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(file and rows, bad files as file and text) of JSON artifacts, an object or an array of objects in each file."""
    whole = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root, wholetext=True)
    whole = whole.select(F.input_file_name().alias("file"), F.trim("value").alias("value"))
    good = F.try_parse_json("value").isNotNull()
    rows = F.when(F.col("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
    parsed = whole.filter(good).select("file", F.explode(F.from_json(rows, ArrayType(StructType.fromDDL(schema)))).alias("r"))
    return parsed.select("file", "r.*"), whole.filter(~good)


def _lines(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(file, size, block, nth, line): lines, ended by \\n, with the bytes of their file, the place of the split that they were read from, and a number that grows within it. No file is a row: large ones are read in splits."""
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "\n").text(root)
    return read.select(F.input_file_name().alias("file"), F.col("_metadata.file_size").alias("size"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("nth"), F.col("value").alias("line"))


def text_lines(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(file, line_no, line): lines of all files in their order, from 0. Numbers are those within a split and the counts of the splits before; lines themselves aren't sorted or shuffled for it, unless Spark joins so."""
    lines = _lines(spark, root, pattern)
    splits = lines.groupBy("file", "block").agg(F.min("nth").alias("from"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    splits = splits.select("file", "block", (before - F.col("from")).alias("shift"))
    return lines.join(splits, ["file", "block"]).select("file", (F.col("nth") + F.col("shift")).cast("int").alias("line_no"), "line")


def head_files(spark: SparkSession, root: str, n: int, pattern: str = "*.json", exclude: str | None = None) -> DataFrame:
    """(file, line_no, line): the first n lines of all files under a folder, but for those in its folder `exclude`; file is the path in it with _ for /. Each task gives at most n lines of a file to be ordered.

    What follows the last \\n is a line too, an empty one where the file ends with it (not seen in compressed files).
    """
    base = re.sub(r"^file:/*|/+$", "", root).lstrip("/")
    rel = F.regexp_replace(F.regexp_replace(F.url_decode("file"), r"^\w+:/+", ""), "^" + re.escape(base) + "/", "")
    lines = _lines(spark, root, pattern).withColumn("file", rel)
    if exclude:
        lines = lines.filter(~F.col("file").startswith(exclude.strip("/") + "/"))
    no = F.row_number().over(Window.partitionBy("file").orderBy("block", "nth"))
    heads = lines.withColumn("no", no).filter(F.col("no") <= n).withColumn("line_no", F.col("no") - 1)
    # the bytes of all lines, each with its end, are those of the file (less a byte order mark) if it ends with \n, else one more
    whole = Window.partitionBy("file")
    left = F.col("size") - F.sum(F.octet_length("line") + 1).over(whole)
    last = (F.col("line_no") + 1 == F.count("*").over(whole)) & (F.col("line_no") + 1 < n)
    parts = heads.withColumn("parts", F.when(last & left.isin(0, 3), F.array("line", F.lit(""))).otherwise(F.array("line")))
    return parts.select(F.replace("file", F.lit("/"), F.lit("_")).alias("file"), "line_no", F.posexplode("parts").alias("more", "line")).select("file", (F.col("line_no") + F.col("more")).alias("line_no"), "line")


ARTIFACTS = "_artifacts"


def artifacts(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, name, path, length) of the files in folders <doc_id>_artifacts; none at all is an error."""
    f = files(spark, root).select("path", "length", "name")
    folder = F.regexp_extract(F.url_decode("path"), rf"([^/]+){ARTIFACTS}/[^/]+$", 1)
    found = f.withColumn("doc_id", folder).filter("doc_id <> ''").select("doc_id", "name", "path", "length")
    if found.isEmpty():
        raise FileNotFoundError(f"no folder ending with {ARTIFACTS} in {root}")
    return found


def to_enrich(found: DataFrame, force: bool = False, source: str = "chunks.json", result: str = "enriched_chunks.json") -> DataFrame:
    """(doc_id) of the artifacts that have chunks and no result of more than the two bytes of an empty list; with force, all that have chunks."""
    have = found.filter(F.col("name") == source).select("doc_id").distinct()
    return have if force else have.join(found.filter((F.col("name") == result) & (F.col("length") > 2)).select("doc_id"), "doc_id", "left_anti")


def html_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of HTML pages (page_id, html): (page_id, ord, tag, text), headings, paragraphs, list items, cells and footers in their order. No markup parser: the tags' contents by pattern."""
    clean = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", "")
    hits = F.regexp_extract_all(clean, F.lit(r"(?is)(<(?:h[1-6]|p|li|td|th|footer|title)\b[^>]*>.*?</(?:h[1-6]|p|li|td|th|footer|title)>)"), 1)
    b = pages.select("page_id", F.posexplode(hits).alias("ord", "block"))
    text = F.regexp_replace(F.regexp_replace("block", r"(?s)<[^>]*>", " "), r"\s+", " ")
    return b.select("page_id", "ord", F.lower(F.regexp_extract("block", r"^<(\w+)", 1)).alias("tag"), F.trim(text).alias("text"))


def html_layout(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(headings, blocks) of HTML pages as chunk_documents() takes them: a page is a document of one page, a block's place its number, a heading's level that of its tag; page furniture (title, footer) isn't text."""
    b = html_blocks(pages).select(F.col("page_id").alias("doc_id"), "ord", F.lit(1).alias("page"), F.col("ord").cast("double").alias("y0"), (F.col("ord") + 0.5).alias("y1"), "text", "tag", F.when(F.col("tag").isin("title", "footer"), "furniture").otherwise("text").alias("block_type"))
    heads = b.filter(F.col("tag").rlike("^h[1-6]$") & (F.col("text") != "")).withColumn("level", F.substring("tag", 2, 1).cast("int"))
    return heads.select("doc_id", "ord", "text", "level", "page", "y0", "y1"), b.drop("tag")

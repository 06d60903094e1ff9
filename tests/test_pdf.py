"""The PDF reader on files made here: plain and compressed objects, fonts with maps, bookmarks, tables, and files that are broken."""

import zlib

import pytest
from pyspark.sql import functions as F

from lamina.operators import models
from lamina.plans.ingestion import chunk_documents, pdf_layout
from lamina.sources import pdf, scan


def make(pages, bookmarks=(), compress=False, packed=False, extra_fonts=""):
    """A file: pages are content streams (bytes), bookmarks (title, page, children)."""
    objects = {}
    n = 10
    kids = []
    for content in pages:
        raw = zlib.compress(content) if compress else content
        objects[n] = b"<< /Length %d %s >>\nstream\n" % (len(raw), b"/Filter /FlateDecode" if compress else b"") + raw + b"\nendstream"
        objects[n + 1] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % n
        kids.append(n + 1)
        n += 2
    objects[2] = b"<< /Type /Pages /Count %d /MediaBox [0 0 600 800] /Resources << /Font << /F1 3 0 R /F2 4 0 R %s >> >> /Kids [%s] >>" % (len(pages), extra_fonts.encode(), b" ".join(b"%d 0 R" % k for k in kids))
    objects[3] = b"<< /Type /Font /Subtype /Type1 /BaseFont /ABCDEF+Body /FirstChar 32 /Widths [%s] >>" % b" ".join([b"500"] * 95)
    objects[4] = b"<< /Type /Font /Subtype /Type1 /BaseFont /Head-Bold /FirstChar 32 /Widths [%s] >>" % b" ".join([b"600"] * 95)
    first = None

    def outline(items):
        nonlocal n
        numbers = list(range(n, n + len(items)))
        n += len(items)
        for k, (title, page, children) in enumerate(items):
            below = outline(children) if children else None
            objects[numbers[k]] = b"<< /Title %s /Dest [%d 0 R /Fit] %s %s >>" % (title, kids[page - 1], b"/Next %d 0 R" % numbers[k + 1] if k + 1 < len(items) else b"", b"/First %d 0 R" % below if below else b"")
        return numbers[0]

    if bookmarks:
        first = outline(bookmarks)
        objects[5] = b"<< /Type /Outlines /First %d 0 R >>" % first
    objects[1] = b"<< /Type /Catalog /Pages 2 0 R %s >>" % (b"/Outlines 5 0 R" if first else b"")
    out = b"%PDF-1.5\n% a comment with (brackets\n"
    if packed:  # everything but streams in an object stream
        inside = {k: v for k, v in objects.items() if b"stream" not in v}
        head, body = b"", b""
        for k, v in inside.items():
            head += b"%d %d " % (k, len(body))
            body += v + b" "
        raw = zlib.compress(head + body)
        objects = {k: v for k, v in objects.items() if k not in inside} | {900: b"<< /Type /ObjStm /N %d /First %d /Length %d /Filter /FlateDecode >>\nstream\n" % (len(inside), len(head), len(raw)) + raw + b"\nendstream"}
    for k, v in objects.items():
        out += b"%d 0 obj\n" % k + v + b"\nendobj\n"
    return out + b"trailer << /Root 1 0 R >>\n%%EOF"


def line(x, y, text, font="F1", size=10):
    return b"BT /%s %d Tf %d %d Td (%s) Tj ET\n" % (font.encode(), size, x, y, text.encode("cp1252"))


@pytest.mark.parametrize("compress", [False, True])
@pytest.mark.parametrize("packed", [False, True])
def test_text_fonts_and_places(compress, packed):
    content = line(50, 700, r"A \(title\) \351", "F2", 16) + b"BT /F1 10 Tf 14 TL 1 0 0 1 50 650 Tm [(Wo) 20 (rds) -600 (apart)] TJ T* (next line) Tj 0 -100 Td <4f6e65> Tj ET q 2 0 0 2 0 0 cm " + line(50, 100, "twice") + b" Q"
    rows = pdf.read_pdf(make([content, b""], compress=compress, packed=packed))
    assert len(rows) == 2 and rows[1]["text"] == "" and rows[1]["blocks"] == []
    spans = [s for b in rows[0]["blocks"] for s in b["spans"]]
    assert [s["text"] for s in spans] == ["A (title) é", "Words apart", "next line", "One", "twice"]
    assert [b["n_lines"] for b in rows[0]["blocks"]] == [1, 2, 1, 1]
    head, body, twice = spans[0], spans[1], spans[-1]
    assert (head["font"], head["size"], head["flags"]) == ("Head-Bold", 16.0, pdf.BOLD) and (body["font"], body["size"], body["flags"]) == ("Body", 10.0, 0)
    assert twice["size"] == 20.0 and twice["x0"] == 100.0
    assert (head["x0"], round(head["y0"], 1), round(head["y1"], 1)) == (50.0, 87.2, 103.2) and head["x1"] == 50 + 10 * 9.6 + 8  # é has no width of its own: the default
    assert (rows[0]["width"], rows[0]["height"]) == (600.0, 800.0)


def test_maps_to_unicode():
    cmap = b"1 beginbfchar <0001> <0416> endbfchar 2 beginbfrange <0002> <0004> <0041> <0005> <0006> [<00660069> <D83DDE00>] endbfrange"
    font = b"6 0 obj << /Type /Font /Subtype /Type0 /BaseFont /Wide /DescendantFonts [7 0 R] /ToUnicode 8 0 R >> endobj 7 0 obj << /DW 1000 /W [1 [250] 2 4 500] >> endobj 8 0 obj << /Length %d >>\nstream\n%s\nendstream endobj " % (len(cmap), cmap)
    data = make([b"BT /F3 10 Tf 10 10 Td <000100020003000400050006> Tj ET"], extra_fonts="/F3 6 0 R").replace(b"trailer", font + b"trailer")
    s = pdf.read_pdf(data)[0]["blocks"][0]["spans"][0]
    assert s["text"] == "ЖABCfi😀" and s["x1"] == pytest.approx(10 + 2.5 + 3 * 5 + 2 * 10)


def test_bookmarks_and_tables():
    rows = [line(50, 700 - 15 * k, a) + line(200, 700 - 15 * k, b) + line(350, 700 - 15 * k, c) for k, (a, b, c) in enumerate([("Arm", "n", "HR"), ("Drug", "100", "0.7"), ("Placebo", "98", "1"), ("All", "198", "-")])]
    marks = [(b"(One)", 1, [(b"(One \\(a\\))", 2, [])]), (b"<FEFF00C4>", 2, [])]
    got = pdf.read_pdf(make([b"".join(rows) + line(50, 400, "Plain text below."), line(50, 700, "Second")], marks))
    assert [tuple(m.values()) for m in got[0]["bookmarks"]] == [(1, "One", 1), (2, "One (a)", 2), (1, "Ä", 2)]
    (t,) = got[0]["tables"]
    assert t["markdown"] == "|Arm|n|HR|\n|---|---|---|\n|Drug|100|0.7|\n|Placebo|98|1|\n|All|198|-|" and t["y1"] < 400 and got[1]["tables"] == []


def test_files_as_tables(spark):
    foot = line(250, 20, "Page footer")
    page = lambda k: line(50, 750, f"Chapter {k}", "F2", 18) + b"".join(line(50, 700 - 28 * i, f"Sentence {k}.{i} is here.") for i in range(23)) + foot
    good = make([page(1), page(2), page(3), page(4)], [(b"(Chapter 1)", 1, []), (b"(Not there)", 2, [])], compress=True)
    files = spark.createDataFrame([("a.pdf", bytearray(good)), ("b.pdf", bytearray(b"%PDF-1.4 nothing")), ("c.pdf", bytearray(b"text")), ("d.pdf", bytearray(good.replace(b"trailer <<", b"trailer << /Encrypt 1 0 R")))], "path string, content binary")
    read = pdf.pages(files).cache()
    assert {r.path: r.error for r in read.filter("error is not null").collect()} == {"b.pdf": "ValueError: no catalogue", "c.pdf": "ValueError: not a PDF file", "d.pdf": "ValueError: encrypted"}
    docs = files.select(F.col("path").alias("doc_id"))
    counts = models.page_counts(docs, read.filter("error is null").select(F.col("path").alias("doc_id")))
    assert {r.doc_id: r.n_pages for r in counts.collect()} == {"a.pdf": 4, "b.pdf": 0, "c.pdf": 0, "d.pdf": 0}
    heads, blocks, _ = pdf_layout(read)
    assert [(r.text, r.page, r.level) for r in heads.orderBy("ord").collect()] == [("Chapter 1", 1, 1), ("Not there", 2, 1), ("Chapter 2", 2, 2), ("Chapter 3", 3, 2), ("Chapter 4", 4, 2)]
    chunks = chunk_documents(heads, blocks).collect()
    by = {tuple(r.section_path): r for r in chunks}
    assert by[("Chapter 1",)].text.startswith("Sentence 1.0 is here.") and by[("Not there", "Chapter 3")].page_numbers == [3]
    assert not any("footer" in r.text for r in chunks)
    ok, bad = scan.texts(files.withColumn("ext", F.lit(".pdf")))
    assert ok.count() == 1 and bad.count() == 3 and "Sentence 3.11" in ok.first().text


def test_odd_files_are_errors_not_crashes():
    good = make([line(1, 1, "x")], compress=True)
    for data in (b"", good[: len(good) // 2], good.replace(b"/FlateDecode", b"/LZWDecode"), b"%PDF-1.4 1 0 obj << /Type /Catalog /Pages 1 0 R >> endobj"):
        try:
            assert isinstance(pdf.read_pdf(data), list)
        except (ValueError, zlib.error):
            pass

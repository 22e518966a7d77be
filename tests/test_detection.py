"""Anchors and chapters against a plain fold over the same candidates."""

import io
import zipfile

from pyspark.sql import functions as F

from quirespark.operators import detection
from quirespark.plans import q_lines
from quirespark.sources import epub


def plain_anchors(cands, words):
    """The same choice, over a list."""
    cands = sorted(cands, key=lambda c: c.line_index)
    last, expected = cands[-1].line_index, max(3, words // 8000)

    def norm(t):
        import re

        return re.sub(r"(?i)^chapter\s+\d+[:\s]*", "", t).lower().strip()

    def named(c, got):
        n = norm(c.title)
        return len(n) >= 5 and any(len(norm(a.title)) >= 5 and (n in norm(a.title) or norm(a.title) in n) for a in got)

    got = []
    for c in cands:
        if c.confidence >= 0.7 and not named(c, got):
            got.append(c)
    likely = [c for c in cands if 0.4 <= c.confidence < 0.7]
    body = [c for c in likely if c.line_index > last // 10]
    gap = max(last // expected // 3, 50)
    low = sorted((c for c in cands if 0.3 <= c.confidence < 0.4 and c.preceded_by_blank and c.followed_by_prose), key=lambda c: (-c.confidence, c.line_index))
    for pool, enough, space in ((body if len(body) >= expected else likely, expected, gap), (low, 3, 20)):
        for c in pool:
            if len(got) < enough and all(abs(c.line_index - a.line_index) >= space for a in got) and not named(c, got):
                got.append(c)
    return sorted(c.line_index for c in got)


def test_anchors_match_a_plain_fold(spark, sf_dir):
    c, a = q_lines._anchors(spark, sf_dir)
    # fewer certain ones, so that all three passes have work
    c = c.withColumn("confidence", F.when(F.col("line_index") % 3 == 0, F.col("confidence")).otherwise(F.col("confidence") - 0.35)).cache()
    words = 60000
    sizes = c.select("book_id").distinct().withColumn("words", F.lit(words))
    got = {}
    for r in detection.select_anchors(c, sizes).collect():
        got.setdefault(r.book_id, []).append(r.line_index)
    by = {}
    for r in c.collect():
        by.setdefault(r.book_id, []).append(r)
    want = {b: plain_anchors(rows, words) for b, rows in by.items()}
    assert {b: sorted(x) for b, x in got.items()} == {b: x for b, x in want.items() if x}


def test_books_without_headings_are_sliced(spark):
    df = spark.createDataFrame([("a", "w " * 6000), ("b", "Chapter 1: One\n\n" + "word " * 600 + "\n\nChapter 2: Two\n\n" + "word " * 700)], "book_id string, text string")
    rows = detection.detect_chapters(df).collect()
    assert sorted((r.book_id, r.chapter_number, r.word_count, r.method) for r in rows) == [("a", 1, 2500, "fixed"), ("a", 2, 2500, "fixed"), ("a", 3, 1000, "fixed"), ("b", 1, 600, "anchors"), ("b", 2, 700, "anchors")]


def test_part_series(spark):
    df = spark.createDataFrame([("b", 1, "T"), ("b", 2, "T (part 2)"), ("b", 3, "T (part 2)"), ("b", 4, "U")], "book_id string, chapter_number int, title string")
    assert [r.title for r in detection.part_series(df).orderBy("chapter_number").collect()] == ["T", "T (part 2)", "T (part 3)", "U"]


def test_epub(spark, tmp_path):
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("META-INF/container.xml", '<container xmlns="x"><rootfiles><rootfile full-path="O/c.opf"/></rootfiles></container>')
        f.writestr(
            "O/c.opf",
            '<package xmlns="x" xmlns:dc="d"><metadata><dc:title>Book</dc:title><dc:creator>Ann</dc:creator></metadata><manifest><item id="a" href="t/a.xhtml" media-type="application/xhtml+xml"/>'
            '<item id="b" href="t/b.xhtml" media-type="application/xhtml+xml"/><item id="n" href="toc.ncx" media-type="application/x-dtbncx+xml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>',
        )
        f.writestr("O/t/a.xhtml", "<html><head><title>x</title></head><body><h1>One</h1><p>Text &amp; more</p></body></html>")
        f.writestr("O/t/b.xhtml", "<html><body><p>" + "word " * 150 + "</p></body></html>")
        f.writestr(
            "O/toc.ncx",
            '<ncx xmlns="x"><navMap><navPoint><navLabel><text>One</text></navLabel><content src="t/a.xhtml#s"/><navPoint><navLabel><text>Sub</text></navLabel><content src="t/a.xhtml#q"/></navPoint></navPoint>'
            '<navPoint><navLabel><text>Index</text></navLabel><content src="t/a.xhtml"/></navPoint></navMap></ncx>',
        )
    (tmp_path / "good.epub").write_bytes(z.getvalue())
    (tmp_path / "bad.epub").write_bytes(b"no zip")
    books = epub.scan(spark, str(tmp_path)).cache()
    assert sorted((r.title or "", r.author or "", bool(r.error)) for r in books.collect()) == [("", "", True), ("Book", "Ann", False)]
    good = books.filter("error IS NULL")
    assert [(r.spine_index, r.line_offset, r.text[:15]) for r in epub.spine_items(good).orderBy("spine_index").collect()] == [(0, 0, "One\nText & more"), (1, 3, "word word word ")]
    points = epub.split_points(good)
    assert sorted((r.title, r.anchor, r.depth) for r in points.collect()) == [("One", "s", 0), ("Section 2", "", 0), ("Sub", "q", 1)]
    assert sorted(r.title for r in epub.chapter_depth(points).collect()) == ["One", "Section 2"]


def test_epub_navigation_document(spark, tmp_path):
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="O/c.opf"/></rootfiles></container>')
        f.writestr("O/c.opf", '<package xmlns:dc="d"><metadata><dc:title>T</dc:title><dc:creator>A B</dc:creator><dc:creator>C D</dc:creator></metadata><manifest><item id="n" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="b" href="b.xhtml" media-type="application/xhtml+xml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>')
        f.writestr("O/nav.xhtml", '<html xmlns:epub="e"><body><nav epub:type="toc"><ol><li><a href="a.xhtml">One <b>more</b></a><ol><li><a href="a.xhtml#x">Inner</a></li></ol></li><li><a href="b.xhtml">Introduction</a></li></ol></nav></body></html>')
        f.writestr("O/a.xhtml", "<p>first</p>")
        f.writestr("O/b.xhtml", "<p>second</p>")
    (tmp_path / "three.epub").write_bytes(z.getvalue())
    books = epub.scan(spark, str(tmp_path))
    r = books.first()
    assert r.author == "A B, C D"
    assert [(e.title, e.href, e.anchor, e.depth) for e in r.toc] == [("One more", "O/a.xhtml", "", 0), ("Inner", "O/a.xhtml", "x", 1), ("Introduction", "O/b.xhtml", "", 0)]
    assert epub.combined_text(books).first().text == "first\n\nsecond"
    assert epub.toc_titles(books).first().titles == ["One more", "Inner"]


def test_files_come_once_and_by_name(spark, tmp_path):
    from quirespark.sources import tables

    (tmp_path / "in").mkdir()
    for n in ("b.epub", "A.pdf", "in/c.epub", "x.txt"):
        (tmp_path / n).write_bytes(b"1")
    assert [r.name for r in tables.files_of(spark, [str(tmp_path), str(tmp_path / "in")]).collect()] == ["A.pdf", "b.epub", "c.epub"]
    assert [r.name for r in tables.books_of_files(spark, str(tmp_path)).collect()] == ["x.txt"]
    got = tables.binary_books(spark, str(tmp_path), lambda b: b.decode() * 2, "*.epub").collect()
    assert [r.text for r in got] == ["11", "11"]

"""Books of very many chapters, lines or candidates: work grows with the book, not with its square."""

import time
from contextlib import contextmanager

from pyspark.sql import functions as F

from quirespark.functions import lines as ln
from quirespark.operators import detection, merging, semantic, splitting


@contextmanager
def within(seconds):
    start = time.monotonic()
    yield
    assert time.monotonic() - start < seconds


def test_anchors_of_a_book_with_many_candidates(spark):
    n = 60_000
    title = F.concat(F.lit("Chapter 1: "), F.sha2(F.col("id").cast("string"), 256))
    c = spark.range(n).select(F.lit("b").alias("book_id"), F.col("id").cast("int").alias("line_index"), title.alias("title"), F.lit(0.8).alias("confidence"), F.lit(True).alias("preceded_by_blank"), F.lit(True).alias("followed_by_prose"))
    # every third title is part of, or holds, one before it
    c = c.withColumn("title", F.when(F.col("line_index") % 3 == 1, F.concat(F.lit("Chapter 2: "), F.substring(F.sha2((F.col("line_index") - 1).cast("string"), 256), 9, 40))).when(F.col("line_index") % 3 == 2, F.concat(F.lit("x"), F.sha2((F.col("line_index") - 2).cast("string"), 256))).otherwise(F.col("title")))
    sizes = spark.createDataFrame([("b", 1000)], "book_id string, words int")
    with within(60):
        got = sorted(r.line_index for r in detection.select_anchors(c, sizes).collect())
    assert got == list(range(0, n, 3))


def test_packs_of_a_book_with_many_chapters(spark):
    n = 60_000
    c = spark.range(n).select(F.lit("b").alias("book_id"), (F.col("id") + 1).cast("int").alias("chapter_number"), F.lit(40).alias("word_count"))
    with within(30):
        rows = sorted(merging.pack(c, 100).collect(), key=lambda r: r.pack)
    assert [(r.pack, r.first_chapter, r.last_chapter, r.word_count) for r in rows] == [(k + 1, 2 * k + 1, 2 * k + 2, 80) for k in range(n // 2)]


def test_nearest_boundaries_of_a_long_book(spark):
    n = 60_000
    c = spark.range(n).select(F.lit("b").alias("book_id"), (F.col("id") * 10).alias("line_index"))
    b = spark.range(n).select(F.lit("b").alias("book_id"), (F.col("id") * 10 + 4).alias("line_index"))
    with within(30):
        rows = semantic.nearest_boundary(c, b).collect()
    assert len(rows) == n and all((r.boundary_line, r.distance) == (r.line_index + 4, 4) for r in rows)


def test_merges_of_a_book_with_many_chapters(spark):
    n = 40_000
    c = spark.range(n).select(F.lit("b").alias("book_id"), (F.col("id") + 1).cast("int").alias("chapter_number"), F.lit("Plain Title").alias("title"), F.lit(100).alias("word_count"))
    with within(60):
        assert merging.auto_merge(c).agg(F.sum("word_count")).first()[0] == n * 100
    with within(60):
        pairs = sorted(r.first for r in merging.chosen_merges(c).collect())
    assert pairs == list(range(0, n - 1, 2))


def test_code_regions_across_gaps(spark):
    """Lines of code, alone and in regions, in a block without any other."""
    text = ["prose"] * 30_000
    for i in (5, 100, 102, 4095, 4097, 20_000):
        text[i] = "$ run it"
    df = spark.createDataFrame(list(enumerate(text)), "line_index int, line string").withColumn("book_id", F.lit("b"))
    got = {r.line_index for r in ln.in_code(df).filter("in_code_block").collect()}
    assert got == {100, 101, 102, 4095, 4096, 4097}


def test_chapters_across_blocks_and_slices_by_lines(spark):
    """A chapter that goes on over several blocks of lines, and slices that end within lines."""
    rows = [("b", i, "w" if i else "Chapter 1: One") for i in range(2 * ln.BLOCK + 10)]
    df = spark.createDataFrame(rows, "book_id string, line_index int, line string")
    c = ln.anchor_contents(df, df.filter("line_index = 0").select("book_id", "line_index", F.col("line").alias("title"))).first()
    assert c.content == "\n".join(["w"] * (2 * ln.BLOCK + 9))
    s = detection.slices_of_lines(spark.createDataFrame([("b", 0, "a b c"), ("b", 1, " "), ("b", 2, "d e f g h i")], "book_id string, line_index int, line string"), 4)
    assert sorted((r.section_number, r.content, r.word_count) for r in s.collect()) == [(1, "a b c d", 4), (2, "e f g h", 4), (3, "i", 1)]


def test_packs_of_a_text_with_many_sentences(spark):
    """Each pack is cut once, not found anew by a fold for every pack."""
    n = 12_000
    df = spark.createDataFrame([(1, "One two three four. " * n)], "doc_id int, text string")
    with within(60):
        rows = splitting.sentence_packs(df, 4).select("pack", "content").collect()
    assert len(rows) == n and {r.content for r in rows} == {"One two three four."}


def test_words_of_chunks_are_counted_right(spark):
    """The count of a chunk is that of its words, taken from the piece before or its own."""
    df = spark.createDataFrame([(1, "\n".join(" ".join(["w"] * k) for k in (3, 40, 7, 90, 1, 12, 60)))], "doc_id int, text string")
    rows = splitting.recursive_split(df, 30, 5, 10).collect()
    assert len(rows) > 5 and all(r.chunk_words == len(r.chunk.split()) for r in rows)

"""Scalars and folds against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from quirespark.functions import lines as ln
from quirespark.functions import text as t
from quirespark.operators import library, merging, semantic, splitting, storage


def one(spark, f, *values):
    df = spark.createDataFrame([values], [f"c{i}" for i in range(len(values))])
    return df.select(f(*[F.col(c) for c in df.columns])).first()[0]


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (t.basic_dashes, "10–20 also—here", "10-20 also--here"),
        (t.llm_dashes, "a—b", "a - b"),
        (t.quotes, "“x” ‘y’", "\"x\" 'y'"),
        (t.basic_control, "Hello\x01World\x07", "HelloWorld"),
        (t.word_count, " a b c \n", 3),
        (t.word_count, "", 0),
        (t.nfkc, "ﬁ①", "fi1"),
        (t.llm_page_numbers, "a\n 12 \nPage 3\nb", "a\nb"),
        (t.is_subsection_title, "Summary", True),
        (t.is_subsection_title, "2.3.1 Setup", True),
        (t.is_subsection_title, "Summary of all", False),
        (t.chapter_number, "Chapter 7: x", 7),
        (t.chapter_number, "3. Title", 3),
        (t.chapter_number, "Title", None),
        (t.normalize_title, "Chapter 3: The End", "the end"),
        (t.sanitize_filename, "A/B: c  d", "ab-c-d"),
        (t.is_title_case, "The Great River", True),
        (t.is_title_case, "the great river", False),
        (t.strip_frontmatter, "---\na: 1\n---\nbody", "body"),
        (t.html_title, "<title>T</title><h1><b>Head</b> &x</h1>", "Head &x"),
        (t.confidence_level, 0.7, "high"),
        (ln.is_code_line, "$ ls", True),
        (ln.is_code_line, "Plain words here.", False),
        (ln.toc_number, "Chapter 4: Rivers", "4"),
    ],
)
def test_scalars(spark, f, given, want):
    assert one(spark, f, given) == want


def test_page_numbers_are_kept_before_the_limit(spark):
    text = "42\n" + "x\n" * 601 + "42"
    assert one(spark, t.basic_page_numbers, text) == "42\n" + "x\n" * 601


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 9) for r in df.select(t.cosine(F.col("a"), F.col("b"))).collect()] == [0.8, 0.0]


def _chapters(spark, sizes, titles=None):
    rows = [("b", i + 1, (titles or [f"T{i}" for i in range(len(sizes))])[i], w) for i, w in enumerate(sizes)]
    return spark.createDataFrame(rows, "book_id string, chapter_number int, title string, word_count int")


def test_profile_and_score(spark):
    p = library.profile(_chapters(spark, [5000, 6000, 5500, 4800, 5200]))
    r = p.withColumn("score", library.quality_score(F.lit(1.0), F.lit(0))).first()
    assert (r.total_words, r.avg_words, r.variance, r.est_tokens, r.score) == (26500, 5300.0, 220000.0, 35333, 97)


def test_merge_scores(spark):
    c = _chapters(spark, [500, 600, 4000, 400], ["Chapter 1: Intro", "Section 2", "Chapter 3: Main", "Summary"])
    got = {r.chapter_number: r.score for r in merging.merge_candidates(c).collect()}
    assert got == {1: 0.85, 2: 0.4, 3: 0.65}


def test_merge_plan(spark):
    got = merging.merge_plan(_chapters(spark, [5000, 400, 6000]), 3000).collect()
    assert [(r.chapter_number, r.into_chapter) for r in got] == [(2, 1)]
    got = merging.merge_plan(_chapters(spark, [100, 400, 6000]), 3000).collect()
    assert [(r.chapter_number, r.into_chapter) for r in got] == [(2, 1)]


def test_fixed_slices(spark):
    df = spark.createDataFrame([("b", " ".join(["w"] * 50000))], "book_id string, text string")
    assert [r.section_words for r in splitting.fixed_slices(df).collect()] == [2500] * 20


def test_balanced_and_oversized_paragraphs(spark):
    df = spark.createDataFrame([(" ".join(["w"] * 21), "T"), (" ".join(["w"] * 25) + "\n\n" + " ".join(["v"] * 5), "T")], "text string, title string").withColumn("id", F.monotonically_increasing_id())
    r = splitting.resplit(df, 10).collect()
    first = min(x.id for x in r)
    assert [x.word_count for x in r if x.id == first] == [7, 7, 7]
    assert [(x.title, x.word_count) for x in r if x.id != first] == [("T", 9), ("T (part 2)", 9), ("T (part 3)", 7), ("T (part 4)", 5)]


def test_percentile_threshold(spark):
    vectors = [[1.0, 0.0], [0.1, (1 - 0.01) ** 0.5]]
    df = spark.createDataFrame([("b", i, v) for i, v in enumerate(vectors)], "book_id string, position int, embedding array<double>")
    assert semantic.similarities(df).first().similarity == 0.1


def test_upsert_keeps_one_row_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    assert sorted(map(tuple, storage.upsert(old, new, "id").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_scores_of_candidates(spark):
    df = spark.createDataFrame([(4, False, True, True, 0), (1, True, False, False, 3)], "k int, code boolean, blank boolean, prose boolean, n int")
    got = [r[0] for r in df.select(ln.score(*[F.col(c) for c in df.columns])).collect()]
    assert got == [0.9, 0.0]


def test_auto_merge(spark):
    c = _chapters(spark, [500, 600, 4000, 400, 30000], ["Chapter 1: Intro", "Section 2", "Chapter 3: Main", "Summary", "Chapter 4: Long"])
    got = merging.auto_merge(c, 8000).orderBy("chapter_number").collect()
    assert [(r.first_chapter, r.last_chapter, r.word_count) for r in got] == [(1, 2, 1100), (3, 3, 4000), (4, 4, 400), (5, 5, 30000)]
    got = merging.auto_merge(c, 20000).orderBy("chapter_number").collect()
    assert [(r.first_chapter, r.last_chapter, r.word_count, r.title) for r in got] == [(1, 4, 5500, "Chapter 1: Intro"), (5, 5, 30000, "Chapter 4: Long")]


def test_one_decimal_is_rounded_as_by_printf(spark):
    given = [9.25, 1.25, 0.75, 6.25, 1.15, 1.05, 0.35, 0.45, 2.5, 0.0, 99.95, 99.96, -0.25, -0.04, -7.35, 100.0, 37 * 100.0 / 2960] + [k / 20 for k in range(400)]
    df = spark.createDataFrame([(x,) for x in given], "x double")
    assert [r[0] for r in df.select(t.one_decimal(F.col("x"))).collect()] == [f"{x:.1f}" for x in given]


def test_titles_within_words_and_without_words(spark):
    """A title may begin and end within words of a line, or hold none."""
    lines = [(1, 0, "Of all"), (1, 1, "Breathe fresh airs"), (1, 2, "the fresh air"), (1, 3, "a --- b"), (1, 4, "mind the gap")]
    df = spark.createDataFrame(lines, "book_id int, line_index int, line string")
    c = spark.createDataFrame([(1, 1, "The fresh air"), (1, 2, "---"), (1, 3, "resh"), (1, 4, "The Gap"), (1, 5, "nowhere at all"), (1, 6, None), (1, 7, "E fresh")], "book_id int, chapter_number int, title string")
    got = {r.chapter_number: r.line_index for r in semantic.title_lines(c, df).collect()}
    assert got == {1: 1, 2: 3, 3: 1, 4: 4, 5: 0, 6: 0, 7: 1}


def test_composition_in_small_slices(spark, monkeypatch):
    """Texts go to the worker in bounded batches and through it in slices; nulls and empty texts stay."""
    monkeypatch.setattr(t, "NFKC_BYTES", 8)
    texts = ["ﬁ" * 10, None, "", "①", "plain", "ﬁ"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    assert [r[0] for r in df.orderBy("i").select(t.nfkc(F.col("s"))).collect()] == ["fi" * 10, None, "", "1", "plain", "fi"]
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        t.bound_batches(spark)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= t.BATCH_BYTES
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)

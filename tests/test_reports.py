"""Messages and reports against values worked out by hand."""

from pyspark.sql import functions as F

from quirespark.operators import reports


def test_validation_messages(spark):
    rows = [(1, i, f"Chapter {i}", w) for i, w in enumerate([50, 3000, 40000, 2000], 1)] + [(2, 1, "Section 1", 500), (2, 2, "Section 2", 600), (3, 1, "A", 60000)]
    c = spark.createDataFrame(rows, "book_id int, chapter_number int, title string, word_count int")
    e = spark.createDataFrame([(1, 6), (2, 9), (3, None)], "book_id int, expected_chapters int")
    got = {r.book_id: r for r in reports.validation_messages(c, e).collect()}
    assert got[1].warnings == [
        "Missing 2 chapters (expected 6, found 4)",
        "Chapter 3 is very large (40,000 words) - may contain missed splits",
        "Very small chapters detected: [1]",
        "Chapter 3 is 13.3x larger than median - may contain missed splits",
    ]
    assert (got[1].errors, got[1].is_valid, len(got[1].recommendations)) == ([], True, 3)
    assert got[2].errors == ["Missing 7 chapters (expected 9, found 2)", "All chapters are generic 'Section N' - pattern-based detection failed, fell back to fixed-size splitting"]
    assert got[3].warnings[0] == "Only 1 chapters for 60,000 words (expected at least 3)"
    assert not got[2].is_valid and got[3].is_valid


def test_compiled_and_pipeline_report(spark):
    df = spark.createDataFrame(
        [(1, ["a"], ["b", "a"], ["c"], ["d", "d"], None, 0.4, "fallback", 60, True, 2, 500, 250.0, 100, 400, 2000, 1500, 500, 25.0)],
        "book_id int, warnings array<string>, errors array<string>, quality_warnings array<string>, semantic_recommendations array<string>, issue_message string, confidence double, method string, quality_score int, validation_valid boolean, "
        "total_chapters int, total_words int, avg_words double, min_words int, max_words int, original_length int, cleaned_length int, bytes_saved int, reduction_percent double",
    )
    r = reports.flags(reports.compiled(df))
    row = r.first()
    assert row.warnings == ["a", "b", "c"]
    assert row.recommendations[0] == "d" and len(row.recommendations) == 4
    assert (row.is_valid, row.needs_review) == (True, True)
    text = reports.pipeline_report(r).first().report
    assert text.startswith("# Book Processing Report\n\n## Summary\n- **Chapters detected:** 2\n- **Detection method:** fallback\n- **Detection confidence:** 40%\n")
    assert "- Bytes saved: 500 (25.0%)" in text and text.endswith("- Moderate quality - some optimization possible")


def test_diagnostics_report(spark):
    counts = spark.createDataFrame([(1, "toc", "high", 9, 1, 3, 4, 2, ["x"], [])], "book_id int, method string, label string, candidates int, anchors int, high int, medium int, low int, issues array<string>, suggestions array<string>")
    a = spark.createDataFrame([(1, 120, 0.9, "Title", False, True, False, 0)], "book_id int, line_index int, confidence double, title string, in_code_block boolean, preceded_by_blank boolean, followed_by_prose boolean, nearby_similar_lines int")
    text = reports.diagnostics_report(counts, a.withColumn("penalties", reports.penalties())).first().report
    assert "Issues Detected:\n  - x\n\nAnchors:\n   1. [✓] Line   120 | 0.90\n      Title: Title\n      Penalties: no_prose_after (-0.3)" in text
    assert "Suggestions" not in text
    assert spark.range(1).select(reports.should_ask(F.lit(0.3), False).alias("a"), reports.should_ask(F.lit(0.3), True).alias("b")).first() == (False, True)

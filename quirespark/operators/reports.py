"""Messages and reports for readers: validations, quality, detection, whole books and libraries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .library import bucket

#: Limits of a validation; fixed values.
TINY, HUGE, OUTLIER = 100, 30000, 5.0
#: Scores and confidences from which a result counts as valid, good, sure; fixed values.
VALID_SCORE, GOOD_SCORE, SURE = 50, 75, 0.7


def _number(x: Column) -> Column:
    return F.format_string("%,d", x.cast("long"))


def validation_messages(chapters: DataFrame, expected: DataFrame) -> DataFrame:
    """(book_id, expected_chapters, actual_chapters, warnings, errors, is_valid, recommendations).

    ``chapters`` has (book_id, chapter_number, title, word_count), ``expected``
    (book_id, expected_chapters), null where nothing is expected. Chapters are
    named by their place in the book.
    """
    one = F.struct("chapter_number", F.col("word_count").cast("long").alias("w"), F.coalesce("title", F.lit("")).alias("t"))
    g = chapters.groupBy("book_id").agg(F.array_sort(F.collect_list(one)).alias("c"))
    g = g.join(expected, "book_id", "left").withColumn("w", F.transform("c", lambda x: x["w"]))
    n, e = F.size("w"), F.col("expected_chapters")
    total = F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + x)
    median = F.element_at(F.array_sort("w"), F.floor(n / 2).cast("int") + 1)
    largest, least = F.array_max("w"), F.greatest(F.lit(3).cast("long"), F.floor(total / 20000))
    gap = e - n
    missing = F.concat(F.lit("Missing "), gap.cast("string"), F.when(gap == 1, " chapter").otherwise(" chapters"), F.lit(" (expected "), e.cast("string"), F.lit(", found "), n.cast("string"), F.lit(")"))
    few = F.concat(F.lit("Only "), n.cast("string"), F.lit(" chapters for "), _number(total), F.lit(" words (expected at least "), least.cast("string"), F.lit(")"))
    numbered = F.transform("w", lambda w, i: F.struct((i + 1).alias("i"), w.alias("w")))
    huge = F.transform(F.filter(numbered, lambda x: x["w"] > HUGE), lambda x: F.concat(F.lit("Chapter "), x["i"].cast("string"), F.lit(" is very large ("), _number(x["w"]), F.lit(" words) - may contain missed splits")))
    tiny = F.filter(numbered, lambda x: x["w"] < TINY)
    small = F.concat(F.lit("Very small chapters detected: ["), F.array_join(F.transform(tiny, lambda x: x["i"].cast("string")), ", "), F.lit("]"))
    ratio = largest / median
    lopsided = F.concat(F.lit("Chapter "), F.array_position("w", largest).cast("string"), F.lit(" is "), F.format_string("%.1f", ratio), F.lit("x larger than median - may contain missed splits"))
    generic = F.forall("c", lambda x: x["t"].rlike(r"^Section\s+\d+$"))
    no_pattern = F.lit("All chapters are generic 'Section N' - pattern-based detection failed, fell back to fixed-size splitting")
    warnings = F.concat(
        F.array_compact(F.array(F.when((e > 0) & gap.between(1, 3), missing), F.when((total > 50000) & (n < least), few))),
        huge,
        F.array_compact(F.array(F.when(F.size(tiny) > 0, small), F.when((n >= 3) & (median > 0) & (ratio > OUTLIER), lopsided))),
    )
    errors = F.array_compact(F.array(F.when((e > 0) & (gap > 3), missing), F.when((n > 0) & generic, no_pattern)))
    g = g.select("book_id", "expected_chapters", n.alias("actual_chapters"), warnings.alias("warnings"), errors.alias("errors"))
    fewer = F.coalesce((F.col("expected_chapters") > 0) & (F.col("actual_chapters") > 0) & (F.col("actual_chapters") < F.col("expected_chapters")), F.lit(False))
    advice = F.concat(
        F.when(fewer, F.array(F.lit("Try reprocessing with --debug to see which chapters are being missed"), F.lit("Check if chapter titles in body differ from TOC titles"))).otherwise(F.array().cast("array<string>")),
        F.transform(F.filter("warnings", lambda x: F.contains(x, F.lit("very large"))), lambda x: F.lit("Large chapters may indicate missed chapter headers - check chapter patterns in config.json")),
    )
    return g.withColumn("is_valid", F.size("errors") == 0).withColumn("recommendations", advice)


def flags(results: DataFrame) -> DataFrame:
    """Add is_valid and needs_review to (validation_valid, quality_score, warnings, confidence)."""
    score = F.col("quality_score")
    valid = F.col("validation_valid") & (score >= VALID_SCORE)
    review = (F.size("warnings") > 0) | (F.col("confidence") < SURE) | (score < GOOD_SCORE)
    return results.withColumn("is_valid", valid).withColumn("needs_review", review)


def should_ask(confidence: Column, has_port: bool, threshold: float = 0.5) -> Column:
    """Whether a model behind a port is asked about a book: only if there is one and the detection is unsure."""
    return (confidence < threshold) if has_port else F.lit(False)


def penalties() -> Column:
    """Names of what has lowered a candidate's score."""
    return F.array_compact(
        F.array(
            F.when(F.col("in_code_block"), "in_code_block (-0.5)"),
            F.when(~F.col("preceded_by_blank"), "no_blank_before (-0.2)"),
            F.when(~F.col("followed_by_prose"), "no_prose_after (-0.3)"),
            F.when(F.col("nearby_similar_lines") >= 2, "list_item (-0.4)"),
        )
    )


def quality_label(score: Column) -> Column:
    return F.when(score >= 90, "Excellent").when(score >= 75, "Good").when(score >= 50, "Fair").otherwise("Poor")


def _bullets(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def quality_report(profiles: DataFrame) -> DataFrame:
    """(book_id, report) as Markdown, of profiles with quality_score, metadata, warnings and info."""
    p = profiles
    report = F.concat(
        F.lit("## Processing Quality Report\n\n**Book ID:** "), F.col("book_id").cast("string"),
        F.lit("\n**Quality Score:** "), F.col("quality_score").cast("string"), F.lit("/100 ("), quality_label(F.col("quality_score")),
        F.lit(")\n\n### Statistics\n- Total Words: "), _number(F.col("total_words")),
        F.lit("\n- Chapters Detected: "), F.col("total_chapters").cast("string"),
        F.lit("\n- Avg Chapter Size: "), F.format_string("%,.0f", F.bround("avg_words", 0)),
        F.lit(" words\n- Min Chapter Size: "), _number(F.col("min_words")),
        F.lit(" words\n- Max Chapter Size: "), _number(F.col("max_words")),
        F.lit(" words\n- Estimated Tokens: "), _number(F.col("est_tokens")),
        F.lit("\n- Metadata Completeness: "), F.format_string("%.0f", F.bround(F.col("metadata") * 100, 0)),
        F.lit("%\n\n### Warnings\n"), F.when(F.size("warnings") > 0, _bullets(F.col("warnings"))).otherwise("None"),
        F.lit("\n\n### Info\n"), F.when(F.size("info") > 0, _bullets(F.col("info"))).otherwise("None"),
    )
    return p.select("book_id", report.alias("report"))


def diagnostics_report(counts: DataFrame, anchors: DataFrame) -> DataFrame:
    """(book_id, report) of a detection: counts with method, label, suggestions; and the anchors with penalties."""
    line = F.concat(
        F.lit("  "), F.lpad(F.col("n").cast("string"), 2, " "), F.lit(". ["), F.when(F.col("confidence") >= SURE, "✓").otherwise("○"), F.lit("] Line "), F.lpad(F.col("line_index").cast("string"), 5, " "),
        F.lit(" | "), F.format_string("%.2f", "confidence"), F.lit("\n      Title: "), "title",
        F.when(F.size("penalties") > 0, F.concat(F.lit("\n      Penalties: "), F.array_join("penalties", ", "))).otherwise(""),
    )
    a = anchors.withColumn("n", F.row_number().over(Window.partitionBy("book_id").orderBy("line_index")))
    a = a.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("n", line.alias("line")))).alias("a"))
    c = counts.join(a, "book_id", "left")

    def listed(title: str, column: str) -> Column:
        items = F.array_join(F.transform(column, lambda x: F.concat(F.lit("  - "), x)), "\n")
        return F.when(F.size(column) > 0, F.concat(F.lit(f"{title}:\n"), items, F.lit("\n\n"))).otherwise("")

    report = F.concat(
        F.lit("=== Chapter Detection Diagnostic: "), F.col("book_id").cast("string"), F.lit(" ===\n\nSummary:\n  Method: "), "method", F.lit("\n  Confidence: "), "label",
        F.lit("\n  Total candidates: "), F.col("candidates").cast("string"), F.lit("\n  Anchors selected: "), F.col("anchors").cast("string"),
        F.lit("\n\nCandidate Distribution:\n  High (>=0.7):   "), F.col("high").cast("string"), F.lit("\n  Medium (0.4-0.7): "), F.col("medium").cast("string"), F.lit("\n  Low (<0.4):     "), F.col("low").cast("string"),
        F.lit("\n\n"), listed("Issues Detected", "issues"), listed("Suggestions", "suggestions"), F.lit("Anchors:\n"),
        F.coalesce(F.array_join(F.transform("a", lambda x: x["line"]), "\n"), F.lit("")),
    )
    return c.select("book_id", report.alias("report"))


def compiled(results: DataFrame) -> DataFrame:
    """Results with all warnings and recommendations of a book's steps, each once and in order.

    ``results`` has the arrays warnings, errors, quality_warnings and
    semantic_recommendations, and issue_message (or null), confidence, method, quality_score.
    """
    issue = F.when(F.col("issue_message").isNotNull(), F.array("issue_message")).otherwise(F.array().cast("array<string>"))
    warnings = F.array_distinct(F.concat("warnings", "errors", "quality_warnings", issue))
    score = F.col("quality_score")
    own = F.array_compact(
        F.array(
            F.when(F.col("confidence") < 0.5, "Low detection confidence - consider manual review of chapter boundaries"),
            F.when(F.col("method") == "fallback", "Fell back to fixed-size splitting - add chapter patterns for this book format"),
            F.when(score < VALID_SCORE, "Low quality score - review chapter detection and text cleaning").when(score < GOOD_SCORE, "Moderate quality - some optimization possible"),
        )
    )
    return results.withColumn("warnings", warnings).withColumn("recommendations", F.array_distinct(F.concat("semantic_recommendations", own)))


def pipeline_report(results: DataFrame) -> DataFrame:
    """(book_id, report) of books as Markdown, from ``flags`` of ``compiled`` results with sizes and cleaning counts."""
    tail = F.concat(
        F.when(F.size("warnings") > 0, F.concat(F.lit("\n\n## ⚠️ Warnings\n"), _bullets(F.col("warnings")))).otherwise(""),
        F.when(F.size("recommendations") > 0, F.concat(F.lit("\n\n## 💡 Recommendations\n"), _bullets(F.col("recommendations")))).otherwise(""),
    )
    sizes = F.concat(
        F.lit("\n- Total words: "), _number(F.col("total_words")), F.lit("\n- Average chapter: "), F.format_string("%,.0f", F.bround("avg_words", 0)),
        F.lit(" words\n- Min chapter: "), _number(F.col("min_words")), F.lit(" words\n- Max chapter: "), _number(F.col("max_words")), F.lit(" words"),
    )
    report = F.concat(
        F.lit("# Book Processing Report\n\n## Summary\n- **Chapters detected:** "), F.col("total_chapters").cast("string"), F.lit("\n- **Detection method:** "), "method",
        F.lit("\n- **Detection confidence:** "), F.format_string("%.0f", F.bround(F.col("confidence") * 100, 0)), F.lit("%\n- **Quality score:** "), F.col("quality_score").cast("string"),
        F.lit("/100\n- **Valid:** "), F.when(F.col("is_valid"), "✅ Yes").otherwise("❌ No"), F.lit("\n- **Needs review:** "), F.when(F.col("needs_review"), "⚠️ Yes").otherwise("✅ No"),
        F.lit("\n\n## Text Cleaning\n- Original size: "), _number(F.col("original_length")), F.lit(" chars\n- Cleaned size: "), _number(F.col("cleaned_length")), F.lit(" chars\n- Bytes saved: "), _number(F.col("bytes_saved")),
        F.lit(" ("), F.format_string("%.1f", "reduction_percent"), F.lit("%)\n\n## Chapter Statistics"), F.when(F.col("total_chapters") > 0, sizes).otherwise(""), tail,
    )
    return results.select("book_id", report.alias("report"))


def worst_first(books: DataFrame, below: int | None = None) -> DataFrame:
    """Books by rising score, of those under ``below`` if that is given."""
    return (books if below is None else books.filter(F.col("quality_score") < below)).orderBy("quality_score", "book_id")


def best_first(books: DataFrame, least: int = 0) -> DataFrame:
    return books.filter(F.col("quality_score") >= least).orderBy(F.col("quality_score").desc(), "book_id")


def problematic(profiles: DataFrame) -> DataFrame:
    """Books whose chapters are too small or too many, the smallest mean first."""
    bad = (F.col("avg_words") < 2000) | ((F.col("total_chapters") > 40) & (F.col("avg_words") < 5000))
    return profiles.filter(bad).orderBy("avg_words", "book_id")


def library_json(books: DataFrame) -> DataFrame:
    """(book_id, json): a line for each book, as an export of a library has them."""
    return books.select("book_id", F.to_json(F.struct(*books.columns), {"ignoreNullFields": "false"}).alias("json"))


def library_markdown(books: DataFrame) -> DataFrame:
    """(book_id, line): a line of Markdown for each book, with its score and class."""
    return books.select("book_id", F.concat(F.lit("- **"), F.col("book_id").cast("string"), F.lit("**: "), F.col("quality_score").cast("string"), F.lit("/100 ("), bucket(F.col("quality_score")), F.lit(")")).alias("line"))


__all__ = [
    "best_first", "compiled", "diagnostics_report", "flags", "library_json", "library_markdown", "penalties", "pipeline_report", "problematic",
    "quality_label", "quality_report", "should_ask", "validation_messages", "worst_first",
]

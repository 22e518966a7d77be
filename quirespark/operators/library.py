"""Library-wide analytics: profiles, quality scores, validations and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits and weights of the quality model.
SMALL, LARGE = 500, 20000
WEIGHTS = {"metadata": 20, "balance": 30, "count": 20, "encoding": 15, "sizes": 15}
REQUIRED, REQUIRED_WEIGHT = ("id", "title"), 1.5
OPTIONAL = ("author", "word_count", "source_file")


def _present(c: str) -> Column:
    s = F.col(c).cast("string")
    return F.coalesce((s != "") & (s != "0"), F.lit(False))


def completeness(columns: set[str] | None = None) -> Column:
    """Weighted share of the metadata fields that hold something."""
    have = set(REQUIRED + OPTIONAL) if columns is None else columns
    parts = [F.when(_present(c), w).otherwise(0.0) for c, w in [*((c, REQUIRED_WEIGHT) for c in REQUIRED), *((c, 1.0) for c in OPTIONAL)] if c in have]
    total = len(REQUIRED) * REQUIRED_WEIGHT + len(OPTIONAL)
    return F.least(F.lit(1.0), sum(parts[1:], parts[0]) / F.lit(total))


def profile(chapters: DataFrame) -> DataFrame:
    """One row for each book: counts and sizes of its chapters."""
    w = F.col("word_count")
    return chapters.groupBy("book_id").agg(
        F.sum(w).cast("long").alias("total_words"),
        F.count("*").alias("total_chapters"),
        F.avg(w).alias("avg_words"),
        F.coalesce(F.var_samp(w), F.lit(0.0)).alias("variance"),
        F.min(w).cast("long").alias("min_words"),
        F.max(w).cast("long").alias("max_words"),
        F.floor(F.sum(w) / F.lit(0.75)).alias("est_tokens"),
        F.count_if(w < SMALL).alias("n_small"),
        F.count_if(w > LARGE).alias("n_large"),
    )


def balance(p: DataFrame) -> Column:
    return F.sqrt("variance") / F.greatest("avg_words", F.lit(1.0))


def quality_score(metadata: Column, encoding_issues: Column) -> Column:
    """0 to 100, of the columns of ``profile``."""
    n = F.col("total_chapters")
    cv = F.sqrt("variance") / F.greatest("avg_words", F.lit(1.0))
    count = F.when(n == 0, 0).when(n == 1, 5).when(n.between(3, 50), WEIGHTS["count"]).when(n > 50, 15).otherwise(10)
    encoding = F.when(encoding_issues == 0, WEIGHTS["encoding"]).when(encoding_issues < 10, 10).otherwise(F.greatest(F.lit(0), 15 - encoding_issues))
    sizes = F.when(n > 0, (1 - (F.col("n_small") + F.col("n_large")) / n) * WEIGHTS["sizes"]).otherwise(0.0)
    balanced = F.when(n > 0, F.greatest(F.lit(0.0), 1 - cv) * WEIGHTS["balance"]).otherwise(0.0)
    return F.floor(F.round(metadata * WEIGHTS["metadata"] + balanced + count + encoding + sizes, 9)).cast("int")


def bucket(score: Column) -> Column:
    return F.when(score >= 75, "good").when(score >= 50, "fair").otherwise("poor")


def validate_chunking(p: DataFrame) -> DataFrame:
    """Add ``verdict``: the first fault of a book's chapter sizes, or valid."""
    n, avg, expected = F.col("total_chapters"), F.col("avg_words"), F.floor(F.greatest(F.lit(3), F.floor(F.col("total_words") / 10000)) / 2)
    verdict = (
        F.when(n == 0, "no_chapters")
        .when(avg < 2000, "over-fragmentation")
        .when((n > 40) & (avg < 5000), "suspicious-fragmentation")
        .when(avg > 25000, "under-fragmentation")
        .when(n < expected, "too_few_chapters")
        .otherwise("valid")
    )
    return p.withColumn("verdict", verdict)


def should_merge(chapters: DataFrame) -> DataFrame:
    w = F.col("word_count")
    g = chapters.groupBy("book_id").agg(F.count("*").alias("n"), F.avg(w).alias("avg"), (F.count_if(w < 2000) / F.count("*")).alias("small"))
    rule = (F.col("n") >= 3) & ((F.col("avg") < 2000) | ((F.col("n") > 40) & (F.col("avg") < 5000)) | (F.col("small") > 0.3))
    return g.select("book_id", rule.alias("should_merge"))


def issues(p: DataFrame) -> DataFrame:
    """(book_id, n_issues, issues): messages joined by a semicolon."""
    n, avg = F.col("total_chapters"), F.col("avg_words")
    found = F.array_compact(
        F.array(
            F.when(avg < 2000, "small average"),
            F.when((n > 40) & (avg < 5000), "many small chapters"),
            F.when(n > 3 * F.greatest(F.lit(3), F.floor(F.col("total_words") / 10000)), "too many chapters"),
        )
    )
    return p.select("book_id", F.size(found).alias("n_issues"), F.array_join(found, ";").alias("issues"))


def chapter_validation(chapters: DataFrame, expected: DataFrame) -> DataFrame:
    """Errors and warnings of each book against its expected number of chapters.

    ``expected`` has (book_id, expected_chapters). The median is the upper one.
    """
    g = chapters.groupBy("book_id").agg(
        F.count("*").alias("n"),
        F.sum("word_count").cast("long").alias("words"),
        F.array_sort(F.collect_list("word_count")).alias("sizes"),
        F.max("word_count").alias("largest"),
        F.count_if(F.col("word_count") < 100).alias("tiny"),
        F.count_if(F.col("word_count") > 30000).alias("huge"),
        F.count_if(F.col("title").rlike(r"^Section\s+\d+$")).alias("generic"),
    )
    g = g.join(expected, "book_id", "left")
    missing = F.coalesce(F.col("expected_chapters") - F.col("n"), F.lit(0))
    median = F.element_at("sizes", (F.floor(F.size("sizes") / 2) + 1).cast("int"))
    errors = F.when(missing > 3, 1).otherwise(0) + F.when((F.col("generic") > 0) & (F.col("generic") == F.col("n")), 1).otherwise(0)
    warnings = (
        F.when(missing.between(1, 3), 1).otherwise(0)
        + F.when((F.col("words") > 50000) & (F.col("n") < F.greatest(F.lit(3), F.floor(F.col("words") / 20000))), 1).otherwise(0)
        + F.col("huge")
        + F.when(F.col("tiny") > 0, 1).otherwise(0)
        + F.when((F.col("n") >= 3) & (median > 0) & (F.col("largest") > 5 * median), 1).otherwise(0)
    )
    return g.select("book_id", "n", median.cast("long").alias("median_words"), errors.cast("long").alias("n_errors"), warnings.cast("long").alias("n_warnings"), (errors == 0).alias("is_valid"))


def library_report(books: DataFrame) -> DataFrame:
    """One row over all books with (score, n_issues, should_merge)."""
    n = F.count("*")
    return books.agg(
        n.alias("books"),
        F.count_if(F.col("score") >= 75).alias("good"),
        F.count_if(F.col("score").between(50, 74)).alias("fair"),
        F.count_if(F.col("score") < 50).alias("poor"),
        F.count_if("should_merge").alias("needs_merge"),
        F.count_if(F.col("n_issues") > 0).alias("has_issues"),
        F.round(F.avg("score"), 6).alias("avg_score"),
    )

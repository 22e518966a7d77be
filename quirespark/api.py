"""The library as a whole: from files to tables of books, chapters and sections.

A library is a folder of three Parquet tables, ``books``, ``chapters`` and
``sections``, each partitioned by batch. A run takes up the files whose content no
completed book has, writes its rows as a new batch and leaves the others alone; a
batch that failed has no rows in ``books``, which is written last, and is taken up
again.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .functions import text as t
from .operators import detection, library, merging, metadata, reports, splitting
from .sources import epub, tables


@dataclass(frozen=True)
class Options:
    """Limits of a run; patterns of headers come before the library's own."""

    min_chapter_words: int = detection.MIN_WORDS
    max_chapter_words: int = detection.MAX_WORDS
    max_section_tokens: int = splitting.MAX_TOKENS
    section_patterns: tuple[str, ...] = ()
    merge: bool = False
    clean: bool = True


def load_options(path: str | None = None) -> Options:
    """Options from a JSON file: the one named, or that in QUIRESPARK_CONFIG; the defaults without one. Unknown keys are an error."""
    path = path or os.environ.get("QUIRESPARK_CONFIG")
    if not path:
        return Options()
    given = json.loads(Path(path).read_text(encoding="utf-8"))
    if "section_patterns" in given:
        given["section_patterns"] = tuple(given["section_patterns"])
    return Options(**given)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, source_file, text, given_title, given_author, given_language) of the .txt and .epub files below ``path``."""
    plain = tables.books_of_files(spark, path).select("book_id", F.col("path").alias("source_file"), "text", *[F.lit(None).cast("string").alias(f"given_{c}") for c in ("title", "author", "language")])
    e = epub.scan(spark, path).filter("error IS NULL")
    body = epub.combined_text(e).withColumnRenamed("source_hash", "book_id")
    given = e.select(F.col("source_hash").alias("book_id"), F.col("path").alias("source_file"), *[F.col(c).alias(f"given_{c}") for c in ("title", "author", "language")])
    books = given.join(body.dropDuplicates(["book_id"]), "book_id").select(*plain.columns)
    return plain.unionByName(books).dropDuplicates(["book_id"])


def process(books: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(books, chapters, sections) of books as ``read_files`` gives them."""
    t.bound_batches(books.sparkSession)
    text = t.clean_llm(F.col("text")) if options.clean else F.col("text")
    described = metadata.extract(books).withColumn("text", text)
    found = detection.detect_chapters(described.select("book_id", "text"), options.min_chapter_words, options.max_chapter_words)
    method = found.groupBy("book_id").agg(F.first("method").alias("method"))
    chapters = splitting.quality_resplit(found)
    if options.merge:
        chapters = merging.merge_chapters(chapters).drop("merged_from")
    keys = ["book_id", "chapter_number"]
    sections = splitting.sections(chapters.withColumnRenamed("content", "text"), keys, options.max_section_tokens, options.section_patterns)
    out = described.drop("text", "given_title", "given_author", "given_language").join(method, "book_id", "left").withColumn("processing_status", F.lit("completed"))
    return out, chapters, sections


def table(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A table of a library, or None if there is none yet."""
    try:
        return spark.read.parquet(f"{folder}/{name}")
    except AnalysisException:
        return None


def ingest(spark: SparkSession, path: str, folder: str, options: Options = Options()) -> str | None:
    """Take up new files; returns the batch, or None if all are there."""
    files, done = read_files(spark, path), table(spark, folder, "books")
    if done is not None:
        files = files.join(done.select("book_id"), "book_id", "left_anti")
    if files.isEmpty():
        return None
    batch = "b" + uuid.uuid4().hex[:12]
    books, chapters, _ = process(files, options)
    chapters.write.mode("overwrite").parquet(f"{folder}/chapters/batch={batch}")
    kept = spark.read.parquet(f"{folder}/chapters/batch={batch}")  # not detected twice
    keys = ["book_id", "chapter_number"]
    sections = splitting.sections(kept.withColumnRenamed("content", "text"), keys, options.max_section_tokens, options.section_patterns)
    sections.write.mode("overwrite").parquet(f"{folder}/sections/batch={batch}")
    books.write.mode("overwrite").parquet(f"{folder}/books/batch={batch}")
    return batch


def completed(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """Rows of the batches that came to their end."""
    rows, books = table(spark, folder, name), table(spark, folder, "books")
    if rows is None or books is None:
        return None
    return rows.join(books.select("batch").distinct(), "batch", "left_semi")


def quality(spark: SparkSession, folder: str) -> DataFrame:
    """(book_id, ..., quality_score, verdict) of every book, the worst first."""
    chapters, books = completed(spark, folder, "chapters"), completed(spark, folder, "books")
    p = library.validate_chunking(library.profile(chapters))
    b = books.select(F.col("book_id").alias("id"), "title", "author", "source_file", F.col("word_count"))
    j = p.join(b, p["book_id"] == b["id"]).withColumn("metadata", library.completeness())
    j = j.withColumn("quality_score", library.quality_score(F.col("metadata"), F.lit(0)))
    return reports.worst_first(j.select("book_id", "title", "total_chapters", "total_words", "avg_words", "min_words", "max_words", "est_tokens", "metadata", "quality_score", "verdict"))


def audit(spark: SparkSession, folder: str) -> DataFrame:
    """Validation messages of the stored chapters of every book."""
    chapters = completed(spark, folder, "chapters")
    none = chapters.select("book_id").distinct().withColumn("expected_chapters", F.lit(None).cast("long"))
    return reports.validation_messages(chapters, none)


def preview_merges(spark: SparkSession, folder: str) -> DataFrame:
    """What merging would bring to each book; nothing is changed."""
    chapters = completed(spark, folder, "chapters")
    return merging.merge_summary(chapters, merging.merge_chapters(chapters))

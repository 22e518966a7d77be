"""Title, author and language of a book, from its file's metadata, name and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, word_count

#: How authors are named, in order of trust.
AUTHORS = (
    r"(?m)(?:by|By|BY)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)",
    r"(?m)(?:Author|AUTHOR):\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)",
    r"(?m)^([A-Z][a-z]+\s+[A-Z][a-z]+)\s*$",
)
#: Beginnings of lines that are no title.
NO_TITLES = ("table of contents", "contents", "praise for", "copyright", "preface")
HEAD, TITLE, FIRST_LINES = 3000, 100, 10


def _given(c: Column) -> Column:
    s = strip(c)
    return F.when(s != "", s)


def title_of_name(path: Column) -> Column:
    """The title that a file's name gives, without edition and what stands in brackets."""
    stem = F.regexp_replace(F.regexp_extract(path, r"[^/]*$", 0), r"(?<=.)\.[^.]*$", "")
    s = F.regexp_replace(stem, r"(?i)\s*-\s*\d+(?:st|nd|rd|th)?\s*Edition", "")
    s = F.regexp_replace(s, r"\s*\([^)]*\)", "")
    return F.substring(strip(F.regexp_replace(s, r"(?U)\s+", " ")), 1, TITLE)


def first_title_line(text: Column) -> Column:
    """The first substantial line that is no heading of front matter, or else the first one."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: F.length(x) > 10)
    fit = F.filter(F.slice(lines, 1, FIRST_LINES), lambda x: ~F.lower(x).rlike("^(?:" + "|".join(NO_TITLES) + ")"))
    return F.substring(F.coalesce(F.get(fit, F.lit(0)), F.get(lines, F.lit(0))), 1, TITLE)


def author_in(text: Column) -> Column:
    head = F.substring(text, 1, HEAD)
    return F.coalesce(*[F.nullif(F.regexp_extract(head, p, 1), F.lit("")) for p in AUTHORS])


def extract(books: DataFrame, text: str = "text", source: str = "source_file") -> DataFrame:
    """Add title, author, language, word_count and processing_status to (source_file, text).

    Columns given_title, given_author and given_language, where there are any,
    hold what the file itself says and come first.
    """
    given = {c: _given(F.col(f"given_{c}")) if f"given_{c}" in books.columns else F.lit(None).cast("string") for c in ("title", "author", "language")}
    named = F.nullif(title_of_name(F.col(source)), F.lit(""))
    body = F.coalesce(F.col(text), F.lit(""))
    t = books.withColumn("title", F.coalesce(given["title"], named))
    t = t.withColumn("title", F.when(F.col("title").isNull() | (F.col("title") == "Unknown Title"), F.coalesce(first_title_line(body), "title")).otherwise(F.col("title")))
    t = t.withColumn("author", F.coalesce(given["author"], author_in(body))).withColumn("language", F.coalesce(given["language"], F.lit("en")))
    return t.withColumn("word_count", word_count(body)).withColumn("processing_status", F.lit("processing"))

"""Anchors of e-books in the text: by fingerprints, against other candidates, and as chains of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lines import EPUB_ANCHOR, EXPLICIT_TYPE, TOC

#: Characters of a fingerprint that are searched for, and for a second try; fixed values.
LONG, SHORT = 50, 30
#: Fewest anchors, and their share of the intended ones, that are trusted alone; fixed values.
FEWEST, COVERAGE = 3, 0.8
#: Fewest chapters of a chain of numbers, and most; fixed values.
CHAIN, LONGEST = 3, 19


def fingerprint_valid(text: Column, fingerprint: Column, offset: Column) -> Column:
    """Whether the fingerprint's first characters stand at the offset (from 0)."""
    head = F.substring(fingerprint, 1, LONG)
    return (F.length(head) > 0) & (F.substr(text, offset + 1, F.length(head)) == head)


def _nearest(text: Column, needle: Column, hint: Column) -> Column:
    """The offset (from 0) of the needle's occurrence nearest to ``hint``; null if there is none."""
    # what comes after the last occurrence that starts before the hint
    head = F.substr(text, F.lit(1), hint + F.length(needle) - 1)
    rest = F.call_function("substring_index", head, needle, F.lit(-1))
    last = F.when(F.contains(head, needle), F.length(head) - F.length(rest) - F.length(needle))
    after = F.call_function("locate", needle, text, (hint + 1).cast("int"))
    following = F.when(after > 0, after - 1)
    return F.when(last.isNull(), following).when(following.isNull() | (hint - last <= following - hint), last).otherwise(following)


def resolve_lines(anchors: DataFrame, books: DataFrame) -> DataFrame:
    """Anchors (book_id, fingerprint, hint, stored_line, ...) with ``line_index``; the unresolved are left out.

    Of all places that hold the fingerprint's first LONG characters (or SHORT,
    where it is longer) the one nearest to the hint counts; without any the
    stored line, if the text has so many. Books are joined by id, and two
    searches around the hint take the place of listing all occurrences.
    """
    t = anchors.join(books.select("book_id", F.col("text").alias("__text")), "book_id")
    fp, hint = F.coalesce("fingerprint", F.lit("")), F.coalesce(F.col("hint").cast("int"), F.lit(0))
    at = F.when(fp != "", _nearest(F.col("__text"), F.substring(fp, 1, LONG), hint))
    at = F.coalesce(at, F.when(F.length(fp) > SHORT, _nearest(F.col("__text"), F.substring(fp, 1, SHORT), hint)))
    line = F.size(F.split(F.substr(F.col("__text"), F.lit(1), at), "\n")) - 1
    stored = F.when(F.col("stored_line").between(0, F.size(F.split("__text", "\n")) - 1), F.col("stored_line"))
    found = F.when(at.isNotNull(), F.when(at == 0, 0).otherwise(line)).otherwise(stored)
    return t.withColumn("line_index", found.cast("int")).filter("line_index IS NOT NULL").drop("__text")


def split_anchors(split_points: DataFrame, anchor_map: DataFrame) -> DataFrame:
    """Split points (book_id, full_href, title, depth) with their places in the text."""
    return split_points.join(anchor_map, ["book_id", "full_href"])


def reliable(anchors: DataFrame, split_points: DataFrame) -> DataFrame:
    """(book_id, reliable): whether a book's anchors may stand alone.

    The intended ones are the split points of depth 0, or those up to 1 where
    there are none.
    """
    s = split_points.groupBy("book_id").agg(F.count_if(F.col("depth") == 0).alias("top"), F.count_if(F.col("depth") <= 1).alias("upper"))
    n = anchors.groupBy("book_id").agg(F.count("*").alias("n"))
    intended = F.when(F.col("top") > 0, F.col("top")).otherwise(F.col("upper"))
    return s.join(n, "book_id", "left").select("book_id", F.coalesce((F.col("n") >= FEWEST) & (intended > 0) & (F.col("n") >= intended * COVERAGE), F.lit(False)).alias("reliable"))


def with_candidates(anchors: DataFrame, candidates: DataFrame, trusted: DataFrame) -> DataFrame:
    """Anchors, and of books whose anchors are not trusted alone also the candidates that
    are no entries of a table of contents and stand on other lines.
    """
    alone = trusted.filter("reliable").select("book_id")
    others = candidates.filter(F.col("match_type") != TOC).join(alone, "book_id", "left_anti").join(anchors.select("book_id", "line_index").distinct(), ["book_id", "line_index"], "left_anti")
    return anchors.select(*candidates.columns).unionByName(others.select(*candidates.columns))


def anchor_counts(split_points: DataFrame) -> DataFrame:
    """(book_id, chapter_count, anchor_count): entries up to depth 2, and those that point into a file."""
    return split_points.groupBy("book_id").agg(F.count_if(F.col("depth") <= 2).alias("chapter_count"), F.count_if(F.contains("full_href", F.lit("#"))).alias("anchor_count"))


def detection_method(anchors: DataFrame) -> DataFrame:
    """(book_id, confidence, method) of the chosen anchors (book_id, confidence, match_type)."""
    sure, kind = F.col("confidence") >= 0.7, F.col("match_type")
    label = F.when(F.bool_and(sure), "high").when(F.bool_or(sure), "medium").otherwise("low")
    method = F.when(F.count_if(kind == EPUB_ANCHOR) == F.count("*"), "epub_anchor").when(F.count_if(kind == TOC) * 2 > F.count("*"), "toc").when(F.bool_or(kind == EXPLICIT_TYPE), "pattern").otherwise("fallback")
    return anchors.groupBy("book_id").agg(label.alias("confidence"), method.alias("method"))


def number_chains(pairs: DataFrame) -> DataFrame:
    """(book_id, number, line_index, title) of each book's chain 1, 2, 3, ... with rising lines.

    ``pairs`` has (book_id, line_index, number, title). Each number takes its
    first place after that of the number before; the chain that starts at the
    first 1 counts, if it has CHAIN members, and ends at LONGEST.
    """
    one = F.struct("line_index", "number", "title")
    b = pairs.filter(F.col("number").between(1, LONGEST)).groupBy("book_id").agg(F.array_sort(F.collect_list(one)).alias("p"))
    kind = "array<struct<line_index:int,number:int,title:string>>"

    # lines come in order, so the next number is taken where it first appears
    def step(acc: Column, x: Column) -> Column:
        return F.when(x["number"] == F.size(acc) + 1, F.concat(acc, F.array(x).cast(kind))).otherwise(acc)

    b = b.withColumn("c", F.aggregate("p", F.array().cast(kind), step)).filter(F.size("c") >= CHAIN)
    c = b.select("book_id", F.explode("c").alias("x"))
    return c.select("book_id", "x.number", "x.line_index", "x.title")


def in_order(candidates: DataFrame) -> DataFrame:
    """Candidates numbered by line within their book."""
    return candidates.withColumn("position", F.row_number().over(Window.partitionBy("book_id").orderBy("line_index")))

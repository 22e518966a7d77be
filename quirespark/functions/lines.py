"""Line tables: splitting, code detection, windows and heading candidates.

A line table has (book_id, line_index, line). Every context test is a window
over the lines around a line. Windows run within blocks of BLOCK lines, each with
HALO lines of its neighbours, so that a book of any length is worked on by many
tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import is_title_case, word_count

# What makes a line look like code.
CODE_LINES = (
    r"^\s*[$#>]{1,2}\s+\w",
    r"^\s*>>>\s",
    r"^\s{4,}\S",
    r"^\t+\S",
    r"^\d+\s+\w+\s+\d+\s+\d+\s+[\d.]+",
    r"^[│├└─┌┐┘┬┴┼]+",
    r"^\s*\|.*\|.*\|",
    r"^[\w./]+:\d+:",
    r"^\s*(?:def|class|import|from|if|for|while|return|async|await)\s",
    r"^\s*(?:function|const|let|var|import|export|if|for|while|return)\s",
)
# Characters of code, and the share of them that is too many for prose.
CODE_CHARS = "()[]{}=<>|&;:'\"\\/@#$%^*+-"
CODE_DENSITY = 0.15
#: Headings that name their kind, and numbered ones.
EXPLICIT = (
    r"(?i)^Chapter\s+\d+[:\s].*$",
    r"^CHAPTER\s+\d+$",
    r"(?i)^Part\s+\d+[:\s].*$",
    r"(?i)^Lesson\s+\d+[:\s].*$",
    r"(?i)^Module\s+\d+[:\s].*$",
    r"(?i)^Unit\s+\d+[:\s].*$",
    r"(?i)^Project\s+\d+[A-Z]?[:\s].*$",
)
GENERIC = (r"^\d+\.\s+[A-Z].{5,}$", r"^\d+\s+[A-Z].{5,}$")
PATTERN, TITLE_CASE, EXPLICIT_TYPE, TOC, EPUB_ANCHOR = 1, 2, 3, 4, 5
#: Scores of match types, and what takes from them.
BASE_SCORES = {EPUB_ANCHOR: 0.95, TOC: 0.9, EXPLICIT_TYPE: 0.8, TITLE_CASE: 0.5, PATTERN: 0.4}
IN_CODE, NO_BLANK, NO_PROSE, IN_LIST = 0.5, 0.2, 0.3, 0.4
#: Entries of a table of contents, with the number in group 1.
TOC_ENTRIES = (
    r"(?i)^Chapter\s+(\d+)[,:]\s+",
    r"(?i)^Project\s+(\d+[A-Z]):",
    r"(?i)^Lesson\s+(\d+)",
    r"(?i)^Module\s+(\d+)",
    r"(?i)^Part\s+(\d+)",
    r"(?i)^Unit\s+(\d+)",
)


#: Lines of a block, and those around it that windows may look at: 49 at most.
BLOCK, HALO = 4096, 64


def _blocks(line_table: DataFrame) -> DataFrame:
    """Each line with its block, and once more for each neighbour that it stands near to."""
    at = F.col("line_index")
    b, r = F.floor(at / BLOCK).cast("int"), at % BLOCK
    of = F.array_compact(F.array(b, F.when((r < HALO) & (b > 0), b - 1), F.when(r >= BLOCK - HALO, b + 1)))
    return line_table.withColumn("__block", F.explode(of))


def _own(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("__block") == F.floor(F.col("line_index") / BLOCK)).drop("__block")


def _by_block() -> Window:
    return Window.partitionBy("book_id", "__block").orderBy("line_index")


def lines(books: DataFrame, text: str = "text") -> DataFrame:
    return books.select("book_id", F.posexplode(F.split(text, "\n")).alias("line_index", "line"))


def any_of(line: Column, patterns: tuple[str, ...]) -> Column:
    """Whether the line has one of the forms, all of which stand at its start: one search for all."""
    forms = [f"(?i:{p[5:]})" if p.startswith("(?i)^") else f"(?:{p[1:]})" for p in patterns]
    return line.rlike(f"^(?:{'|'.join(forms)})")


def dense_in_code_chars(line: Column) -> Column:
    stripped = F.length(F.trim(line))
    # numbers are counted only where there are digits enough for four
    numbers = line.rlike(r"^(?:[^0-9]*+[0-9]){4}") & (F.regexp_count(line, F.lit(r"\b\d+\b")) >= 4)
    chars = F.length(line) - F.length(F.regexp_replace(line, f"[{re.escape(CODE_CHARS)}]+", ""))
    return (stripped >= 10) & (numbers | (chars.cast("double") / stripped > CODE_DENSITY))


def is_code_line(line: Column) -> Column:
    return (F.trim(line) != "") & (any_of(line, CODE_LINES) | dense_in_code_chars(line))


def _by_book() -> Window:
    return Window.partitionBy("book_id").orderBy("line_index")


def code_regions(line_table: DataFrame, gap: int = 2, smallest: int = 2) -> DataFrame:
    """(book_id, start_line, end_line): runs of code lines at most ``gap`` apart."""
    code = line_table.filter(is_code_line(F.col("line"))).select("book_id", "line_index")
    new = F.when(F.col("line_index") - F.lag("line_index").over(_by_book()) <= gap, 0).otherwise(1)
    runs = code.withColumn("new", new).withColumn("run", F.sum("new").over(_by_book()))
    spans = runs.groupBy("book_id", "run").agg(F.min("line_index").alias("start_line"), F.max("line_index").alias("end_line"))
    return spans.filter(F.col("end_line") - F.col("start_line") + 1 >= smallest).drop("run")


def in_code(line_table: DataFrame) -> DataFrame:
    """Add in_code_block, from the run that a line falls into (no range join)."""
    return _own(_in_code(_blocks(line_table)))


def non_code_lines(line_table: DataFrame) -> DataFrame:
    """The lines outside of code regions."""
    return in_code(line_table).filter(~F.col("in_code_block")).drop("in_code_block")


def _in_code(line_table: DataFrame) -> DataFrame:
    """``in_code`` on blocks; code further away than 2 lines doesn't matter.

    A line lies within a region when the run of the code lines before it goes on
    with the code line after it, and the region is large enough.
    """
    code = F.when(is_code_line(F.col("line")), F.col("line_index"))
    # what comes after is what came before in the other direction: a frame that
    # ends with its partition is summed up anew for every row
    before, after = [Window.partitionBy("book_id", "__block").orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("line_index"), F.col("line_index").desc())]
    t = line_table.withColumn("__code", code).withColumn("__next", F.last("__code", True).over(after)).withColumn("__prev", F.last("__code", True).over(before))
    inside = F.col("__next") - F.col("__prev") <= 2
    # alone: a code line whose neighbours among code lines are over 2 away
    near = F.coalesce(F.col("line_index") - F.col("__prev") <= 2, F.lit(False)) | F.coalesce(F.col("__next") - F.col("line_index") <= 2, F.lit(False))
    t = t.withColumn("in_code_block", F.coalesce(F.when(F.col("__code").isNotNull(), near).otherwise(inside), F.lit(False)))
    return t.drop("__code", "__prev", "__next")


def context(line_table: DataFrame) -> DataFrame:
    """Add preceded_by_blank, followed_by_prose and nearby_similar_lines."""
    return _own(_context(_blocks(line_table)))


def _context(line_table: DataFrame) -> DataFrame:
    w = _by_block()
    t = line_table.withColumn("__stripped", F.trim("line"))
    numbered = F.when(F.col("__stripped").rlike(r"^\d+[.\s]"), 1).otherwise(0)
    # prose is ten words, so that no line's are counted further
    ten = F.when(F.col("line").rlike(r"(?U)^\s*+(?:\S++\s++){9}\S"), 10).otherwise(word_count(F.col("line")))
    t = t.withColumn("__numbered", numbered).withColumn("__words", ten)
    t = t.withColumn("preceded_by_blank", F.coalesce(F.lag("__stripped").over(w) == "", F.lit(True)))
    t = t.withColumn("followed_by_prose", F.coalesce(F.sum("__words").over(w.rowsBetween(1, 49)), F.lit(0)) >= 10)
    around = F.sum("__numbered").over(w.rowsBetween(-5, 5)) - 1
    t = t.withColumn("nearby_similar_lines", F.when(F.col("__numbered") == 1, around).otherwise(F.lit(0)).cast("int"))
    return t.drop("__stripped", "__numbered", "__words")


def match_type(stripped: Column) -> Column:
    return F.when(any_of(stripped, EXPLICIT), EXPLICIT_TYPE).when(any_of(stripped, GENERIC), PATTERN).when(is_title_case(stripped), TITLE_CASE)


def score(kind: Column, code: Column, blank: Column, prose: Column, similar: Column) -> Column:
    base = F.lit(0.4)
    for k, v in BASE_SCORES.items():
        base = F.when(kind == k, F.lit(v)).otherwise(base)
    less = F.when(code, IN_CODE).otherwise(0.0) + F.when(~blank, NO_BLANK).otherwise(0.0) + F.when(~prose, NO_PROSE).otherwise(0.0) + F.when(similar >= 2, IN_LIST).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), base - less)), 6)


def candidates(line_table: DataFrame) -> DataFrame:
    """Scored heading candidates: lines of 3 to 100 characters of a known kind."""
    t = _context(_in_code(_blocks(line_table))).withColumn("__s", F.trim("line")).withColumn("__next", F.trim(F.lead("line").over(_by_block())))
    t = _own(t).filter(F.length("__s").between(3, 100)).withColumn("match_type", match_type(F.col("__s"))).filter("match_type IS NOT NULL")
    standalone = F.col("__s").rlike(r"^CHAPTER\s+\d+$") & (F.length("__next") > 3) & F.col("__next").rlike(r"^[A-Z]")
    t = t.withColumn("title", F.when(standalone, F.concat_ws(": ", "__s", "__next")).otherwise(F.col("__s")))
    t = t.withColumn("confidence", score(F.col("match_type"), F.col("in_code_block"), F.col("preceded_by_blank"), F.col("followed_by_prose"), F.col("nearby_similar_lines")))
    return t.select("book_id", "line_index", "title", "match_type", "preceded_by_blank", "followed_by_prose", "nearby_similar_lines", "in_code_block", "confidence")


def toc_number(line: Column) -> Column:
    s = F.trim(line)
    return F.coalesce(*[F.when(s.rlike(p), F.regexp_extract(s, p, 1)) for p in TOC_ENTRIES])


def toc_expected(line_table: DataFrame, first: int = 500) -> DataFrame:
    """Distinct chapter numbers in the first lines of each book; null where none."""
    head = line_table.filter(F.col("line_index") < first).withColumn("n", toc_number(F.col("line")))
    counted = head.groupBy("book_id").agg(F.countDistinct("n").alias("n"))
    return counted.select("book_id", F.when(F.col("n") > 0, F.col("n")).alias("expected_chapters"))


def anchor_contents(line_table: DataFrame, anchors: DataFrame) -> DataFrame:
    """Text between each anchor line and the next; what precedes the first is dropped.

    ``anchors`` has (book_id, line_index, title).
    """
    c = joined_lines(placed_lines(line_table, anchors))
    return c.select("book_id", F.col("anchor.line_index").alias("line_index"), F.col("anchor.title").alias("title"), "content")


def placed_lines(line_table: DataFrame, anchors: DataFrame) -> DataFrame:
    """The lines from a book's first anchor on, with ``anchor``: the (line_index, title) that each belongs to.

    Each block of lines takes up the last anchor of the blocks before it.
    """
    block = F.floor(F.col("line_index") / BLOCK).alias("__block")
    at = F.struct("line_index", "title").alias("__a")
    a = anchors.select("book_id", block, at)
    last = a.groupBy("book_id", "__block").agg(F.max_by("__a", "__a.line_index").alias("__a"))
    blocks = line_table.select("book_id", block).distinct().join(last, ["book_id", "__block"], "left")
    earlier = Window.partitionBy("book_id").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("book_id", "__block", F.last("__a", True).over(earlier).alias("__earlier"))
    t = line_table.join(anchors.select("book_id", "line_index", at), ["book_id", "line_index"], "left").withColumn("__block", block)
    t = t.withColumn("__own", F.last("__a", True).over(_by_block().rowsBetween(Window.unboundedPreceding, 0)))
    t = t.join(blocks, ["book_id", "__block"]).withColumn("anchor", F.coalesce("__own", "__earlier"))
    return t.filter("anchor IS NOT NULL").select("book_id", "line_index", "line", "anchor")


def joined_lines(placed: DataFrame) -> DataFrame:
    """(book_id, anchor, content): the lines of each anchor but its own, in order."""
    body = F.when(F.col("line_index") != F.col("anchor.line_index"), F.struct("line_index", "line"))
    groups = placed.groupBy("book_id", "anchor").agg(F.array_sort(F.collect_list(body)).alias("b"))
    return groups.select("book_id", "anchor", F.array_join(F.transform("b", lambda x: x["line"]), "\n").alias("content"))


def running(line_table: DataFrame, value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the lines of the book that come before, by blocks."""
    t = line_table.withColumn("__block", F.floor(F.col("line_index") / BLOCK)).withColumn("__v", value)
    earlier = Window.partitionBy("book_id").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = t.groupBy("book_id", "__block").agg(F.sum("__v").alias("__t")).select("book_id", "__block", F.coalesce(F.sum("__t").over(earlier), F.lit(0)).alias("__b"))
    own = F.coalesce(F.sum("__v").over(_by_block().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return t.withColumn("__own", own).join(totals, ["book_id", "__block"]).withColumn(name, F.col("__own") + F.col("__b")).drop("__block", "__v", "__own", "__b")


def line_offsets(line_table: DataFrame) -> DataFrame:
    """Add char_offset: where the line begins in the book."""
    w = _by_book().rowsBetween(Window.unboundedPreceding, -1)
    return line_table.withColumn("char_offset", F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)))

"""Tables of contents: titles from a book's first lines, and candidates matched to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lines import TOC
from ..functions.text import normalize_for_matching, strip, titles_match

#: Forms of entries, with the title in group 2; the first form with
#: ENOUGH entries among the first ENTRY_LINES lines is the book's.
ENTRIES = (
    r"^Chapter\s+(\d+):\s+(.+?)(?:\s+\.\s|\.\s*\.|\s*\.{2,})",
    r"(?i)^Chapter\s+(\d+),\s+([^,]+)",
    r"(?i)^Chapter\s+(\d+):\s+([^\.]+?)(?:\.{2,}|\s*$)",
    r"(?i)^Chapter\s+(\d+)\s*-\s*(.+?)(?:\s+\.|\s*\.{2,}|\s*$)",
    r"^(\d{1,2})\.\s+(.+?)(?:\s+\.|\s*\.{2,})",
    r"(?i)^Project\s+(\d+[A-Z]):\s+(.+)",
    r"^(\d{2})\s+([A-Z][^0-9]{15,})$",
)
ENOUGH, ENTRY_LINES = 3, 600
#: Lines searched for numbers with a title on a line below.
NUMBER_LINES, CHAPTER_LINES, MARKER_LINES = 1000, 400, 400
#: Titles of sections, which no number announces.
SECTION_TITLES = (
    "(?i)^(Technical requirements|Getting ready|How to do it|How it works|There.s more|Tere.s more|Hands-on exercises|"
    r"Exercise \d|Understanding \w+$|Introduction to [\w\'\-]+.s|Common data|Common attributes|Working with metadata|Best practices for|"
    "Hyperparameter tuning|Encoding categorical|Scaling techniques|Cleaning and|Handling missing|Feature engineering$|"
    "Practical exercises|Pipelines and workﬂow|Transformers and the|Handling custom|What is a|Visualizing|Table of Contents|Te impact|The impact)"
)
#: Lines that an internal table of contents may take up; fixed value.
CUT_OFF = 1000


def titles(lines: DataFrame) -> DataFrame:
    """(book_id, titles): the titles of a book's table of contents in order; books without one have no row.

    ``lines`` is a line table. Each form of an entry and each kind of chain
    (numbers from 1 without a gap, with their titles on the lines below) is a
    method; the first method that finds ENOUGH titles counts.
    """
    w = Window.partitionBy("book_id").orderBy("line_index")
    t = lines.filter(F.col("line_index") <= NUMBER_LINES + 1).withColumn("s", strip(F.col("line")))
    t = t.withColumn("next", F.lead("s").over(w)).withColumn("third", F.lead("s", 2).over(w))
    at = F.col("line_index")

    def entry(k: int) -> Column:
        title = F.regexp_replace(strip(F.regexp_extract("s", ENTRIES[k], 2)), r"[ \t\n\r.]+$", "")
        ok = (at < ENTRY_LINES) & F.col("s").rlike(ENTRIES[k]) & (F.length(title) >= 3) & ~title.rlike('^["\u201c\u201d]')
        return F.when(ok, F.struct(F.lit(k).alias("method"), at.cast("int").alias("key"), title.alias("title")))

    def below(k: int, number: str, ok: Column, line: str, least: int) -> Column:
        title = F.regexp_replace(line, r"\s+\d+\s*$", "")
        n = F.regexp_extract("s", number, 1)
        ok = F.col("s").rlike(number) & F.coalesce(ok, F.lit(False)) & (F.length(title) >= least)
        return F.when(ok, F.struct(F.lit(k).alias("method"), F.try_to_number(n, F.lit("99999")).cast("int").alias("key"), title.alias("title")))

    large, k = F.col("next").rlike(r"^\p{Lu}"), len(ENTRIES)
    chains = [
        below(k, r"^(\d{1,2})$", (at < NUMBER_LINES) & (F.length("next") > 20) & large & ~F.col("next").rlike(SECTION_TITLES), "next", 6),
        below(k + 1, r"(?i)^CHAPTER\s+(\d+)\s*$", (at < CHAPTER_LINES) & (F.length("next") > 10) & large, "next", 6),
        below(k + 2, r"^(\d{1,2})$", (at < MARKER_LINES) & (F.col("next") == "I") & (F.length("third") >= 4) & F.col("third").rlike(r"^\p{Lu}"), "third", 4),
    ]
    found = t.select("book_id", "line_index", F.explode(F.array_compact(F.array(*[entry(i) for i in range(k)], *chains))).alias("x")).select("book_id", "line_index", "x.*")
    # of a number the first occurrence; then numbers from 1 without a gap
    once = Window.partitionBy("book_id", "method", "key").orderBy("line_index")
    chain = found.filter(F.col("method") >= k).withColumn("r", F.row_number().over(once)).filter("r = 1 AND key >= 1")
    chain = chain.withColumn("r", F.row_number().over(Window.partitionBy("book_id", "method").orderBy("key"))).filter("key = r").drop("r")
    every = found.filter(F.col("method") < k).unionByName(chain)
    every = every.groupBy("book_id", "method").agg(F.array_sort(F.collect_list(F.struct("key", "title"))).alias("l")).filter(F.size("l") >= ENOUGH)
    best = every.groupBy("book_id").agg(F.min_by("l", "method").alias("l"))
    return best.select("book_id", F.transform("l", lambda x: x["title"]).alias("titles"))


def match_titles(candidates: DataFrame, toc: DataFrame, external: bool = False) -> DataFrame:
    """``candidates`` (book_id, line_index, title, match_type, ...) with the type TOC where a title matches.

    In line order every candidate takes the first title of its book that is not
    taken yet and holds it, is held by it, or is much the same; candidates
    before CUT_OFF lines take none, unless the titles come from outside. A fold
    over a book's candidates, whose state is the titles taken.
    """
    start = 0 if external else CUT_OFF
    one = F.struct(F.col("line_index").alias("at"), normalize_for_matching(F.col("title")).alias("norm"))
    c = candidates.filter(F.col("line_index") >= start).groupBy("book_id").agg(F.array_sort(F.collect_list(one)).alias("c"))
    named = F.transform("titles", lambda x: F.struct(normalize_for_matching(x).alias("norm"), x.alias("title")))
    b = c.join(toc.select("book_id", named.alias("t")), "book_id")
    kind = "struct<used:array<string>,lines:array<int>>"

    def step(acc: Column, x: Column) -> Column:
        def fits(y: Column) -> Column:
            return ~F.array_contains(acc["used"], y["title"]) & (F.contains(x["norm"], y["norm"]) | F.contains(y["norm"], x["norm"]) | titles_match(x["norm"], y["norm"]))

        hit = F.get(F.filter("t", fits), F.lit(0))["title"]
        grown = F.struct(F.concat(acc["used"], F.array(hit)).alias("used"), F.concat(acc["lines"], F.array(x["at"].cast("int"))).alias("lines")).cast(kind)
        return F.when(hit.isNull(), acc).otherwise(grown)

    empty = F.struct(F.array().alias("used"), F.array().alias("lines")).cast(kind)
    taken = b.select("book_id", F.explode(F.aggregate("c", empty, step)["lines"]).alias("line_index")).withColumn("__toc", F.lit(True))
    out = candidates.join(taken.distinct(), ["book_id", "line_index"], "left")
    return out.withColumn("match_type", F.when(F.col("__toc"), F.lit(TOC)).otherwise(F.col("match_type"))).drop("__toc").select(*candidates.columns)


def with_numbered(candidates: DataFrame, numbered: DataFrame) -> DataFrame:
    """``candidates`` and ``numbered`` ones together; of equal titles before CUT_OFF lines only the numbered."""
    titles_ = numbered.select("book_id", F.lower("title").alias("__title")).distinct()
    same = (candidates["book_id"] == titles_["book_id"]) & (F.lower(candidates["title"]) == titles_["__title"]) & (candidates["line_index"] < CUT_OFF)
    return candidates.join(titles_, same, "left_anti").unionByName(numbered)

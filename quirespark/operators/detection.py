"""Chapter detection: from candidates to anchors to chapters.

Anchors are chosen in one pass over a book's candidates in line order, as whether
one is taken depends on those taken before; candidates stream through Python, and
what it holds are the places of a book's anchors and an index of their titles.
Books are independent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lines as ln
from ..functions.folds import ordered
from ..functions.text import normalize_title, word_count, words
from .splitting import part_series, quality_resplit

if TYPE_CHECKING:
    import pyarrow as pa

# Fixed values of anchor selection.
HIGH, MEDIUM, LOW = 0.7, 0.4, 0.3
FEWEST, WORDS_PER_CHAPTER = 3, 8000
SPACING, LOW_SPACING = 50, 20
MIN_WORDS, MAX_WORDS, SECTION_WORDS = 500, 50000, 2500

def _choose(fewest: int, low_spacing: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pass over candidates (book_id, line_index, title, confidence, norm, stage, enough, spacing).

    They come by book, stage and order. A candidate is taken unless there are enough, or it is
    near to one taken, or one of the two normalized titles holds the other (both of 5 characters
    or more). Workers need nothing of this package.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        steps = (5, 8, 16, 32, 64)  # lengths of the grams that titles are found by

        class Titles:
            """Titles taken, with those that a new one holds, or is held by, at hand."""

            def __init__(self) -> None:
                self.all: list[str] = []
                self.known: set[str] = set()
                self.lengths: dict[str, set[int]] = {}  # of titles by their first 5 characters
                self.grams: dict[int, int | list[int]] = {}  # titles by the grams that they hold

            def alike(self, c: str) -> bool:
                if c in self.known:
                    return True
                n = len(c)
                for i in range(n - 4):  # a title taken, within this one
                    for k in self.lengths.get(c[i : i + 5], ()):
                        if i + k <= n and c[i : i + k] in self.known:
                            return True
                k = max(x for x in steps if x <= n)  # this one, within a title taken: by its rarest gram
                best = None
                for i in range(n - k + 1):
                    found = self.grams.get(hash(c[i : i + k]))
                    if found is None:
                        return False
                    if isinstance(found, int):
                        return c in self.all[found]
                    if best is None or len(found) < len(best):
                        best = found
                return any(c in self.all[j] for j in best)

            def add(self, c: str) -> None:
                at, n = len(self.all), len(c)
                self.all.append(c)
                self.known.add(c)
                self.lengths.setdefault(c[:5], set()).add(n)
                for k in steps:
                    for h in {hash(c[i : i + k]) for i in range(n - k + 1)}:
                        found = self.grams.get(h)
                        if found is None:
                            self.grams[h] = at
                        elif isinstance(found, int):
                            self.grams[h] = [found, at]
                        else:
                            found.append(at)

        class Places:
            """Lines taken, by cells as wide as the least distance."""

            def __init__(self, lines: list[int], width: int) -> None:
                self.width, self.cells = max(width, 1), {}
                for x in lines:
                    self.add(x)

            def add(self, x: int) -> None:
                lo, hi = self.cells.get(x // self.width, (x, x))
                self.cells[x // self.width] = (min(lo, x), max(hi, x))

            def near(self, x: int) -> bool:
                c = x // self.width
                if c in self.cells:
                    return True
                return (c - 1 in self.cells and x - self.cells[c - 1][1] < self.width) or (c + 1 in self.cells and self.cells[c + 1][0] - x < self.width)

        first, book, titles, taken, places, at = True, None, Titles(), [], None, 1
        for b in batches:
            keep = []
            cols = [b.column(i).to_pylist() for i in (0, 1, 4, 5, 6, 7)]
            for i, (g, line, norm, stage, enough, spacing) in enumerate(zip(*cols, strict=True)):
                if first or g != book:
                    first, book, titles, taken, places, at = False, g, Titles(), [], None, 1
                if stage > 1:
                    if stage != at:
                        at, places = stage, None
                    if len(taken) >= (enough if stage == 2 else fewest):
                        continue
                    if places is None:
                        places = Places(taken, spacing if stage == 2 else low_spacing)
                    if places.near(line):
                        continue
                long = norm is not None and len(norm) >= 5
                if long and titles.alike(norm):
                    continue
                if long:
                    titles.add(norm)
                taken.append(line)
                if places is not None:
                    places.add(line)
                keep.append(i)
            yield b.take(pa.array(keep, pa.int32())).select([0, 1, 2, 3])

    return run


def select_anchors(candidates: DataFrame, sizes: DataFrame) -> DataFrame:
    """(book_id, line_index, title, confidence) of the chosen candidates.

    ``sizes`` has (book_id, words). All certain candidates are taken; where they
    are fewer than the book's size lets expect, likely ones that are well apart;
    and with hardly any, unlikely ones in a good place.
    """
    book = Window.partitionBy("book_id")
    x, line = F.col("confidence"), F.col("line_index")
    low = (x >= LOW) & F.col("preceded_by_blank") & F.col("followed_by_prose")
    stage = F.when(x >= HIGH, 1).when(x >= MEDIUM, 2).when(low, 3)
    c = candidates.select("book_id", line.cast("int").alias("line_index"), "title", x.cast("double").alias("confidence"), normalize_title(F.col("title")).alias("norm"), stage.alias("stage"), "preceded_by_blank", "followed_by_prose")
    c = c.join(sizes.select("book_id", "words"), "book_id").withColumn("last", F.max("line_index").over(book))
    c = c.withColumn("enough", F.greatest(F.lit(FEWEST), F.floor(F.col("words") / WORDS_PER_CHAPTER)).cast("int"))
    c = c.withColumn("spacing", F.greatest(F.floor(F.floor(F.col("last") / F.col("enough")) / 3), F.lit(SPACING)).cast("int"))
    body = line > F.floor(F.col("last") / 10)
    c = c.withColumn("bodies", F.count_if((F.col("stage") == 2) & body).over(book))
    c = c.filter("stage IS NOT NULL").filter((F.col("stage") != 2) | body | (F.col("bodies") < F.col("enough")))
    # unlikely ones come by confidence, then line
    c = c.withColumn("rank", F.when(F.col("stage") == 3, -x).otherwise(0.0))
    rows = ordered(c, "book_id", "stage", "rank", "line_index", "norm", "title", "confidence", "preceded_by_blank", "followed_by_prose")
    rows = rows.select("book_id", "line_index", "title", "confidence", "norm", "stage", "enough", "spacing")
    return rows.mapInArrow(_choose(FEWEST, LOW_SPACING), rows.select("book_id", "line_index", "title", "confidence").schema)


def drop_odd_sizes(chapters: DataFrame, least: int = MIN_WORDS, most: int = MAX_WORDS) -> DataFrame:
    """Chapters up to ``most`` words; of these only those from ``least`` on, if two or more are."""
    w = Window.partitionBy("book_id")
    kept = chapters.filter(F.col("word_count") <= most).withColumn("__n", F.count_if(F.col("word_count") >= least).over(w))
    return kept.filter((F.col("word_count") >= least) | (F.col("__n") < 2)).drop("__n")


def detect_chapters(books: DataFrame, least: int = MIN_WORDS, most: int = MAX_WORDS) -> DataFrame:
    """(book_id, chapter_number, title, content, word_count, method) of every book.

    By anchors where the book has any that leave chapters which are no degenerate
    result, else in fixed slices. ``books`` has (book_id, text).
    """
    return chapters_of_lines(ln.lines(books), books.select("book_id", word_count(F.col("text")).alias("words")), least, most)


def chapters_of_lines(table: DataFrame, sizes: DataFrame, least: int = MIN_WORDS, most: int = MAX_WORDS) -> DataFrame:
    """``detect_chapters`` of books as lines (book_id, line_index, line), with their ``sizes`` (book_id, words).

    Which chapters stay is told from the words of their lines; only the lines of those are put together.
    """
    anchors = select_anchors(ln.candidates(table), sizes).persist()  # a few numbers and a title for each; not chosen twice
    placed = ln.placed_lines(table, anchors)
    body = F.when(F.col("line_index") != F.col("anchor.line_index"), word_count(F.col("line"))).otherwise(0)
    found = placed.groupBy("book_id", "anchor").agg(F.sum(body).cast("int").alias("word_count")).select("book_id", F.col("anchor.line_index").alias("line_index"), F.col("anchor.title").alias("title"), "word_count")
    found = drop_odd_sizes(found, least, most)
    found = found.join(degenerate(found, sizes).filter("degenerate").select("book_id"), "book_id", "left_anti").persist()
    kept = found.select("book_id", F.struct("line_index", "title").alias("anchor"), "word_count")
    contents = ln.joined_lines(placed.join(kept.select("book_id", "anchor"), ["book_id", "anchor"], "left_semi"))
    done = contents.join(kept, ["book_id", "anchor"]).select("book_id", F.col("anchor.line_index").alias("line_index"), F.col("anchor.title").alias("title"), "content", "word_count", F.lit("anchors").alias("method"))
    rest = table.join(found.select("book_id").distinct(), "book_id", "left_anti")
    fixed = slices_of_lines(rest, SECTION_WORDS).select("book_id", F.col("section_number").alias("line_index"), F.concat(F.lit("Section "), "section_number").alias("title"), "content", "word_count", F.lit("fixed").alias("method"))
    n = F.row_number().over(Window.partitionBy("book_id").orderBy("line_index"))
    return done.unionByName(fixed).select("book_id", n.alias("chapter_number"), "title", "content", "word_count", "method")


def slices_of_lines(table: DataFrame, size: int) -> DataFrame:
    """(book_id, section_number, content, word_count): slices of ``size`` words of books as lines; white space becomes one space.

    A line gives each slice that it reaches into its words there.
    """
    t = ln.running(table.withColumn("__w", words(F.col("line"))).filter(F.size("__w") > 0), F.size("__w").cast("long"), "__before")
    n, before = F.size("__w"), F.col("__before")
    t = t.withColumn("section", F.explode(F.sequence(F.floor(before / size), F.floor((before + n - 1) / size))))
    start = F.greatest(F.col("section") * size - before, F.lit(0)).cast("int")
    end = F.least((F.col("section") + 1) * size - before, n.cast("long")).cast("int")
    t = t.select("book_id", "section", "line_index", F.slice("__w", start + 1, end - start).alias("w"))
    g = t.groupBy("book_id", "section").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("line_index", "w"))), lambda x: x["w"])).alias("w"))
    return g.select("book_id", (F.col("section") + 1).cast("int").alias("section_number"), F.array_join("w", " ").alias("content"), F.size("w").alias("word_count"))


#: Words under which a chapter counts as tiny; fixed value.
TINY = 100


def degenerate(chapters: DataFrame, sizes: DataFrame) -> DataFrame:
    """(book_id, chapters, tiny, captured, degenerate) of the books with chapters.

    A result is degenerate where it has several chapters, over half of them
    tiny, and holds less than half of the book's words.
    """
    g = chapters.groupBy("book_id").agg(F.count("*").alias("chapters"), F.count_if(F.col("word_count") < TINY).alias("tiny"), F.sum("word_count").alias("captured"))
    bad = (F.col("chapters") > 1) & (F.col("tiny") * 2 > F.col("chapters")) & (F.col("captured") * 2 < F.col("words"))
    return g.join(sizes, "book_id").select("book_id", "chapters", "tiny", "captured", bad.alias("degenerate"))


def detect_all(books: DataFrame, least: int = MIN_WORDS, most: int = MAX_WORDS) -> DataFrame:
    """``detect_chapters`` held to the bounds of ``quality_resplit``."""
    return quality_resplit(detect_chapters(books, least, most))


def diagnostics(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """(book_id, counts, issues): how sure the detection was, and what speaks against it."""
    x = F.col("confidence")
    c = candidates.groupBy("book_id").agg(F.count("*").alias("candidates"), F.count_if(x >= HIGH).alias("high"), F.count_if((x >= MEDIUM) & (x < HIGH)).alias("medium"), F.count_if(x < MEDIUM).alias("low"))
    a = anchors.groupBy("book_id").agg(F.count("*").alias("anchors"), F.count_if(x < HIGH).alias("unsure"), F.count_if(F.col("line_index") < 100).alias("early"))
    j = c.join(a, "book_id", "left").fillna(0, ["anchors", "unsure", "early"])
    issues = F.array_compact(
        F.array(
            F.when(F.col("unsure") > 0, "medium anchors"),
            F.when(F.col("anchors") == 0, "fallback"),
            F.when(F.col("candidates") > 500, "many candidates"),
            F.when((F.col("anchors") > 3) & (F.col("early") > 3), "anchors in front matter"),
        )
    )
    return j.withColumn("issues", F.array_join(issues, ";"))


#: Characters of a book that a model behind a port is shown; fixed value.
SAMPLE = 10_000


def ask_when_unsure(results: DataFrame, port: Callable[[str, str, float], tuple[float, str]] | None, threshold: float = 0.5) -> DataFrame:
    """Results (book_id, text, confidence, ...) with what a model adds to unsure ones: more confidence, up to 1, and ``advice``.

    ``port`` gets a book's id, the beginning of its text and the confidence. Without
    one nothing is asked.
    """
    if port is None:
        return results.withColumn("advice", F.lit(None).cast("string"))
    import pandas as pd

    schema = T.StructType([f for f in results.schema if f.name != "advice"]).add("advice", "string")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.copy()
            f["advice"] = pd.Series([None] * len(f), index=f.index, dtype=object)
            for i in f.index[f["confidence"] < threshold]:
                more, f.at[i, "advice"] = port(str(f.at[i, "book_id"]), (f.at[i, "text"] or "")[:SAMPLE], float(f.at[i, "confidence"]))
                f.at[i, "confidence"] = min(1.0, f.at[i, "confidence"] + more)
            yield f[schema.fieldNames()]

    return results.mapInPandas(run, schema)

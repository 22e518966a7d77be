"""Merging of small chapters: scores of neighbours, folds and plans.

Folds run inside one book, over its chapters' sizes in order: as arrays in
Catalyst, or as streams of rows where a book may have very many. Books are folded
in parallel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folds import bind, cut_at, group_starts, ordered, packed
from ..functions.text import chapter_number, is_subsection_title, strip

SMALL, TARGET_LOW, TARGET_HIGH, TOO_LARGE = 2000, 3000, 15000, 25000


def merge_candidates(chapters: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Neighbours that may be merged, with a score and its reasons, and the columns ``keep`` of the first one."""
    w = Window.partitionBy("book_id").orderBy("chapter_number")
    t = chapters.select("book_id", "chapter_number", "word_count", "title", *keep, F.lead("word_count").over(w).alias("next_words"), F.lead("title").over(w).alias("next_title"))
    t = t.filter("next_words IS NOT NULL").withColumn("combined", F.col("word_count") + F.col("next_words")).filter(F.col("combined") <= TOO_LARGE)
    a, b = chapter_number(F.col("title")), chapter_number(F.col("next_title"))
    gap = F.coalesce((a > 0) & (b > 0) & (b != a + 1), F.lit(False))
    rules = [
        (F.col("word_count") < SMALL, 0.3, "small"),
        (F.col("next_words") < SMALL, 0.3, "next small"),
        (is_subsection_title(F.col("next_title")), 0.25, "subsection"),
        (gap, 0.2, "gap"),
        (F.col("combined").between(TARGET_LOW, TARGET_HIGH), 0.1, "good size"),
    ]
    score = F.lit(0.0)
    for cond, value, _ in rules:
        score = score + F.when(cond, value).otherwise(0.0)
    reasons = F.array_join(F.array_compact(F.array(*[F.when(c, r) for c, _, r in rules])), ";")
    t = t.withColumn("score", F.round(F.least(F.lit(1.0), score), 6)).withColumn("reasons", reasons)
    return t.filter("reasons <> ''").select("book_id", "chapter_number", "combined", "score", "reasons", *keep)


def top_candidates(candidates: DataFrame, k: int = 5) -> DataFrame:
    w = Window.partitionBy("book_id").orderBy(F.col("score").desc(), "chapter_number")
    return candidates.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def sizes_of(chapters: DataFrame) -> DataFrame:
    """(book_id, chapters): ordered structs of number n and words w."""
    one = F.struct(F.col("chapter_number").alias("n"), F.col("word_count").cast("long").alias("w"))
    return chapters.groupBy("book_id").agg(F.array_sort(F.collect_list(one)).alias("chapters"))


def _fold(items: Column, takes: Callable[[Column, Column], Column]) -> Column:
    """Left fold into groups of (first, last, words); ``takes(words, w)``: a group takes the next chapter."""
    groups = bind(items, lambda all_: cut_at(all_, group_starts(F.transform(all_, lambda x: x["w"]), takes)))
    return F.transform(groups, lambda g: F.struct(g[0]["n"].alias("first"), F.element_at(g, -1)["n"].alias("last"), F.aggregate(g, F.lit(0).cast("long"), lambda s, x: s + x["w"]).alias("words")))


def merge_small(chapters: DataFrame, low: int = 3000, high: int = 15000) -> DataFrame:
    """Chapters after a left fold: while the current one is under ``low`` words it
    takes the next, up to ``high`` together. Where too few would be left the book
    stays as it is.
    """
    folded = sizes_of(chapters).withColumn("merged", _fold(F.col("chapters"), lambda held, w: (held < low) & (held + w <= high)))
    total = F.aggregate("chapters", F.lit(0).cast("long"), lambda s, x: s + x["w"])
    least = F.greatest(F.lit(2), F.floor(total / high))
    same = F.transform("chapters", lambda x: F.struct(x["n"].alias("first"), x["n"].alias("last"), x["w"].alias("words")))
    keep = (F.size("merged") < least) & (least <= F.size("chapters"))
    out = folded.select("book_id", F.posexplode(F.when(keep, same).otherwise(F.col("merged"))).alias("i", "c"))
    return out.select("book_id", (F.col("i") + 1).alias("chapter_number"), F.col("c.first").alias("first_chapter"), F.col("c.last").alias("last_chapter"), F.col("c.words").alias("word_count"))


def pack(chapters: DataFrame, limit: int) -> DataFrame:
    """Greedy packing of chapters in order: a pack takes the next while it fits."""
    p = packed(chapters, "book_id", "chapter_number", "word_count", lambda held, w: held + w <= limit)
    return p.groupBy("book_id", "pack").agg(F.min("chapter_number").alias("first_chapter"), F.max("chapter_number").alias("last_chapter"), F.sum("word_count").alias("word_count"))


def merge_plan(chapters: DataFrame, smallest: int = 3000) -> DataFrame:
    """What to merge into what: a small chapter goes into the one before it; where
    that one has gone itself, or there is none, it takes the next one in.
    """
    kind = "struct<plan:array<struct<n:int,into:int>>,prev:int,gone:boolean,takes:boolean>"
    start = F.struct(F.array().alias("plan"), F.lit(None).alias("prev"), F.lit(False).alias("gone"), F.lit(False).alias("takes")).cast(kind)

    def step(acc: Column, x: Column) -> Column:
        small = x["w"] < smallest
        back = small & acc["prev"].isNotNull() & ~acc["gone"]
        goes = acc["takes"] | back
        plan = F.when(goes, F.concat(acc["plan"], F.array(F.struct(x["n"].alias("n"), acc["prev"].alias("into"))))).otherwise(acc["plan"])
        return F.struct(plan.alias("plan"), x["n"].alias("prev"), goes.alias("gone"), (small & ~goes).alias("takes")).cast(kind)

    out = sizes_of(chapters).select("book_id", F.explode(F.aggregate("chapters", start, step)["plan"]).alias("p"))
    return out.select("book_id", F.col("p.n").alias("chapter_number"), F.col("p.into").alias("into_chapter"))


def auto_merge(chapters: DataFrame, target: int = 8000, least: float = 0.2) -> DataFrame:
    """Merge the best-scoring neighbours, one pair at a time, until a book's mean
    reaches ``target`` words or no pair scores ``least``.

    (book_id, chapter_number, first_chapter, last_chapter, title, word_count). The
    scores change with every merge, so a book is worked through in one Python
    group: a row for each chapter, without contents, and a heap of the pairs.
    """
    import pandas as pd

    from ..functions.text import SUBSECTION

    small, low, high, most = SMALL, TARGET_LOW, TARGET_HIGH, TOO_LARGE
    schema = chapters.select("book_id").schema
    schema = schema.add("chapter_number", "integer").add("first_chapter", "integer").add("last_chapter", "integer").add("title", "string").add("word_count", "long")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import heapq
        import re

        subsection = re.compile(SUBSECTION)
        pdf = pdf.sort_values("chapter_number")
        book = pdf["book_id"].iloc[0]
        all_ = [[int(n), int(n), t or "", int(w)] for n, t, w in zip(pdf["chapter_number"], pdf["title"], pdf["word_count"], strict=True)]

        def number(title: str) -> int:
            m = re.match(r"(?i)chapter\s+(\d+)|(\d+)\.\s+|(\d+)\s+[A-Z]", title)
            return int(next(g for g in m.groups() if g)) if m else 0

        def score(a: list, b: list) -> float:
            both = a[3] + b[3]
            if both > most:
                return 0.0
            x, y = number(a[2]), number(b[2])
            s = 0.3 * (a[3] < small) + 0.3 * (b[3] < small) + 0.25 * bool(subsection.match(b[2].strip())) + 0.2 * bool(x and y and y != x + 1) + 0.1 * (low <= both <= high)
            return min(1.0, s)

        total, left = sum(c[3] for c in all_), len(all_)  # merges don't change the total
        after, before = list(range(1, left)) + [None], [None] + list(range(left - 1))
        version = [0] * left
        # the best pair, and of those as good the first; what a merge has outdated is passed over
        heap = [(-round(score(a, b), 9), i, 0, 0) for i, (a, b) in enumerate(zip(all_, all_[1:]))]
        heapq.heapify(heap)
        while left > 1 and total / left < target:
            best, i, u, v = heapq.heappop(heap)
            j = after[i] if all_[i] is not None else None
            if j is None or (version[i], version[j]) != (u, v):
                continue
            if -best < least:
                break
            a, b = all_[i], all_[j]
            title = a[2] if number(a[2]) or not subsection.match(a[2].strip()) else f"{a[2]} + {b[2]}"
            all_[i], all_[j] = [a[0], b[1], title, a[3] + b[3]], None
            version[i] += 1
            left -= 1
            after[i] = after[j]
            if after[j] is not None:
                before[after[j]] = i
            # only the scores with the neighbours are others now
            for x, y in ((before[i], i), (i, after[i])):
                if x is not None and y is not None:
                    heapq.heappush(heap, (-round(score(all_[x], all_[y]), 9), x, version[x], version[y]))
        all_ = [c for c in all_ if c is not None]
        rows = [(book, k + 1, *c) for k, c in enumerate(all_)]
        return pd.DataFrame(rows, columns=["book_id", "chapter_number", "first_chapter", "last_chapter", "title", "word_count"])

    return chapters.select("book_id", "chapter_number", "title", "word_count").groupBy("book_id").applyInPandas(run, schema)


#: Least score of a merge, the mean that merges work towards, and the words that one merge brings; fixed values.
LEAST_SCORE, IDEAL_WORDS, WORDS_A_MERGE = 0.3, 8000, 2000
_GAP = "\n\n---\n\n"


def chosen_merges(chapters: DataFrame, most: int | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """(book_id, first, second): positions from 0 of the neighbours to merge, each chapter in one pair at most.

    By falling score, and then position. Without ``most`` as many of the best
    candidates are looked at as might bring the book's mean to IDEAL_WORDS, or
    all where it is there. Those that meet a pair taken before are left out.
    """
    order = Window.partitionBy("book_id").orderBy("chapter_number")
    t = chapters.select("book_id", "chapter_number", "title", "word_count").withColumn("at", F.row_number().over(order) - 1)
    book = Window.partitionBy("book_id")
    t = t.withColumn("n", F.count("*").over(book)).withColumn("mean", F.avg("word_count").over(book))
    c = merge_candidates(t, ("at", "n", "mean")).filter(F.col("score") >= least)
    if most is None:
        needed = ((IDEAL_WORDS - F.col("mean")) / WORDS_A_MERGE * F.col("n") / 2).cast("int")
        looked = F.when(F.col("mean") < IDEAL_WORDS, F.greatest(F.lit(1), needed)).otherwise((1 << 31) - 1)
    else:
        looked = F.lit(most)
    c = c.select("book_id", "at", (-F.col("score")).alias("k"), looked.cast("int").alias("looked"))

    def run(batches):
        import pyarrow as pa

        first, book, seen, taken = True, None, 0, set()
        for b in batches:
            keep = []
            for i, (g, at, most_) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True)):
                if first or g != book:
                    first, book, seen, taken = False, g, 0, set()
                seen += 1
                if seen <= most_ and at not in taken and at - 1 not in taken and at + 1 not in taken:
                    taken.add(at)
                    keep.append(i)
            yield b.take(pa.array(keep, pa.int32())).select([0, 1])

    pairs = ordered(c, "book_id", "k", "at").mapInArrow(run, c.select("book_id", "at").schema)
    return pairs.select("book_id", F.col("at").alias("first"), (F.col("at") + 1).alias("second"))


def merged_title(first: Column, second: Column) -> Column:
    """The first title, if it is a chapter's own; else both."""
    own = (F.coalesce(chapter_number(first), F.lit(0)) != 0) | ((F.coalesce(first, F.lit("")) != "") & ~is_subsection_title(first))
    return F.when(F.coalesce(own, F.lit(False)), first).otherwise(F.concat(F.coalesce(first, F.lit("")), F.lit(" + "), F.coalesce(second, F.lit(""))))


def merge_chapters(chapters: DataFrame, most: int | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """Chapters (book_id, chapter_number, title, word_count, content) with the chosen pairs merged.

    (book_id, chapter_number, title, content, word_count, merged_from): numbered
    anew, ``merged_from`` has the two titles of a merged chapter.
    """
    order = Window.partitionBy("book_id").orderBy("chapter_number")
    t = chapters.withColumn("at", F.row_number().over(order) - 1)
    pairs = chosen_merges(chapters, most, least)
    t = t.join(pairs.select("book_id", F.col("second").alias("at"), F.lit(1).alias("joins")), ["book_id", "at"], "left")
    t = t.withColumn("group", F.col("at") - F.coalesce("joins", F.lit(0)))
    one = F.struct("at", "title", "content", F.col("word_count").cast("long").alias("word_count"))
    g = t.groupBy("book_id", "group").agg(F.array_sort(F.collect_list(one)).alias("l"))
    a, b = F.get("l", F.lit(0)), F.get("l", F.lit(1))
    two, left, right = F.size("l") == 2, strip(F.coalesce(a["content"], F.lit(""))), F.coalesce(b["content"], F.lit(""))
    content = F.when(two, F.concat(left, F.when((left != "") & (right != ""), _GAP).otherwise(""), strip(right))).otherwise(a["content"])
    return g.select(
        "book_id",
        F.row_number().over(Window.partitionBy("book_id").orderBy("group")).alias("chapter_number"),
        F.when(two, merged_title(a["title"], b["title"])).otherwise(a["title"]).alias("title"),
        content.alias("content"),
        F.when(two, a["word_count"] + b["word_count"]).otherwise(a["word_count"]).alias("word_count"),
        F.when(two, F.array(F.coalesce(a["title"], F.lit("")), F.coalesce(b["title"], F.lit("")))).alias("merged_from"),
    )


def merge_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """(book_id, original_count, merged_count, merges_performed, quality_improvement): by how much the mean has grown."""
    a = before.groupBy("book_id").agg(F.count("*").alias("original_count"), F.avg("word_count").alias("__a"))
    b = after.groupBy("book_id").agg(F.count("*").alias("merged_count"), F.avg("word_count").alias("__b"))
    j = a.join(b, "book_id")
    return j.select("book_id", "original_count", "merged_count", (F.col("original_count") - F.col("merged_count")).alias("merges_performed"), (F.col("__b") - F.col("__a")).alias("quality_improvement"))

"""Splitting of chapters: fixed slices, greedy packs, sections by headers and recursion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folds import bind, cut_at, greedy, group_starts
from ..functions.text import estimate_tokens, sentences, strip, words

#: Separators of the recursive splitter with their kinds, coarse to fine; fixed values.
SEPARATORS = (
    (r"\n\s*(?=Chapter\s+\d+)", "chapter"),
    (r"\n\s*(?=CHAPTER\s+\d+)", "chapter"),
    (r"\n\s*(?=Part\s+\d+)", "section"),
    (r"\n\s*(?=Section\s+\d+)", "section"),
    (r"\n\n+", "paragraph"),
    (r"\n", "line"),
    (r"(?<=[.!?])\s+", "sentence"),
    (r"\s+", "word"),
)
#: Separators that know chapters; fixed values.
CHAPTER_SEPARATORS = (
    (r"\n\s*(?=CHAPTER\s+\d+)", "chapter"),
    (r"\n\s*(?=Chapter\s+\d+)", "chapter"),
    (r"\n\s*(?=PART\s+[IVX\d]+)", "section"),
    (r"\n\s*(?=Part\s+[IVX\d]+)", "section"),
    (r"\n\s*(?=Section\s+\d+)", "section"),
    (r"\n\s*(?=MODULE\s+\d+)", "section"),
    (r"\n\s*(?=Lesson\s+\d+)", "section"),
    (r"\n\s*(?=\d+\.\s+[A-Z])", "section"),
    (r"\n{3,}", "paragraph"),
    (r"\n\n+", "paragraph"),
    (r"\n", "line"),
    (r"(?<=[.!?])\s+", "sentence"),
    (r"\s+", "word"),
)
#: Target, least and most words of chapter-aware chunks; fixed values.
IDEAL_WORDS, LEAST_WORDS, MOST_WORDS = 8000, 3000, 15000
#: Headers of sections, matched without regard to case; fixed values.
HEADERS = (
    r"#{2,4}\s+.+",
    r"\d+\.\d+(?:\.\d+)?\s+[A-Z].+",
    r"[A-Z][A-Z\s]{10,60}",
    r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,6}",
    r"(?:Introduction|Summary|Conclusion|Overview|Background|Prerequisites|Setup|Installation|Configuration|Implementation|Example|Exercise|Review|Key\s+(?:Points|Takeaways|Concepts))(?:\s*:)?",
)
#: Estimated tokens of a section; fixed value.
MAX_TOKENS = 15000
#: What a book's chapters are held to: fewest chapters, most words of one, and of
#: one against the median; and the least words to split at. Fixed values.
FEWEST_CHAPTERS, MOST_CHAPTER_WORDS, MOST_TO_MEDIAN, LEAST_SPLIT = 7, 20000, 4.0, 500


def fixed_slices(chapters: DataFrame, size: int = 2500, text: str = "text") -> DataFrame:
    """Slices of ``size`` words titled Section 1, 2, ...; white space becomes one space."""
    t = chapters.withColumn("__w", words(F.col(text))).filter(F.size("__w") > 0)
    t = t.withColumn("__at", F.explode(F.sequence(F.lit(0), F.size("__w") - 1, F.lit(size))))
    part = F.slice("__w", F.col("__at") + 1, F.lit(size))
    n = (F.col("__at") / size).cast("int") + 1
    return t.select(*[c for c in chapters.columns if c != text], n.alias("section_number"), F.concat(F.lit("Section "), n).alias("section_title"), F.size(part).alias("section_words"), F.array_join(part, " ").alias("content"))


def balanced_slices(w: Column, limit: int | Column) -> Column:
    """Slices of nearly equal size of an array of words, none above ``limit``."""

    def slices(w: Column) -> Column:
        n = F.size(w)
        parts = F.floor((n + limit - 1) / limit)
        size = F.floor((n + parts - 1) / parts).cast("int")
        return F.when(n <= limit, F.array(w)).otherwise(F.transform(F.sequence(F.lit(0), n - 1, size), lambda at: F.slice(w, at + 1, size)))

    return bind(w, slices)


def _pack(items: Column, weight: Callable[[Column], Column], limit: int | Column, joiner: str) -> Column:
    """Greedy packs of strings in order, as structs of text and weight; each string is weighed once."""
    return _join(F.transform(items, lambda x: F.struct(x.alias("t"), weight(x).cast("int").alias("n"))), limit, joiner)


def _join(weighed: Column, limit: int | Column, joiner: str) -> Column:
    """``_pack`` of structs of text t and weight n."""
    return F.transform(greedy(weighed, lambda x: x["n"], limit), lambda g: F.struct(F.array_join(F.transform(g, lambda x: x["t"]), joiner).alias("t"), F.aggregate(g, F.lit(0), lambda n, x: n + x["n"]).alias("n")))


def resplit(chapters: DataFrame, limit: int | Column, text: str = "text", count: Column | None = None) -> DataFrame:
    """Chapters above ``limit`` words, split at blank lines and packed again.

    A paragraph above the limit is cut into balanced slices; part k > 1 of a
    title ends in "(part k)". ``count`` is the number of the text's words, where it is known.
    """
    count = F.size(words(F.col(text))) if count is None else count
    paragraphs = F.filter(F.transform(F.split(text, r"\n(?U:\s)*\n"), strip), lambda p: p != "")

    def weighed(p: Column) -> Column:
        def of(w: Column) -> Column:
            slices = F.transform(balanced_slices(w, limit), lambda s: F.struct(F.array_join(s, " ").alias("t"), F.size(s).alias("n")))
            return F.when(F.size(w) <= limit, F.array(F.struct(p.alias("t"), F.size(w).alias("n")))).otherwise(slices)

        return bind(words(p), of)

    packs = _join(F.flatten(F.transform(paragraphs, weighed)), limit, "\n\n")
    t = chapters.withColumn("__n", count)
    whole = F.array(F.struct(F.col(text).alias("t"), F.col("__n").alias("n")))
    t = t.select(*[c for c in chapters.columns if c not in (text, "word_count")], F.posexplode(F.when(F.col("__n") <= limit, whole).otherwise(packs)).alias("i", "x"))
    title = F.when(F.col("i") == 0, F.col("title")).otherwise(F.concat("title", F.lit(" (part "), F.col("i") + 1, F.lit(")")))
    return t.select(*[c for c in t.columns if c not in ("i", "x", "title")], title.alias("title"), (F.col("i") + 1).alias("part"), F.col("x.n").alias("word_count"), F.col("x.t").alias("content"))


def quality_resplit(chapters: DataFrame, text: str = "content", fewest: int = FEWEST_CHAPTERS, most: int = MOST_CHAPTER_WORDS, ratio: float = MOST_TO_MEDIAN) -> DataFrame:
    """Chapters (book_id, chapter_number, title, text) split until their sizes are in bounds.

    (book_id, chapter_number, title, content, word_count). Three rounds, each of
    three steps: chapters above ``most`` words are split; where a book has under
    ``fewest``, its largest ones are split at half of that until the count would
    do; chapters of over ``ratio`` times the median are split at twice the median.
    A round that changes nothing leaves nothing to the next. Windows run by book,
    and a book stays where it is throughout.
    """
    book = Window.partitionBy("book_id")
    t = chapters.select("book_id", F.array(F.col("chapter_number").cast("int")).alias("path"), "title", F.col(text).alias("content"), F.size(words(F.col(text))).alias("word_count")).filter("content IS NOT NULL")

    def split(t: DataFrame, where: Column, limit: Column | int) -> DataFrame:
        bound = F.when(where, F.lit(limit) if isinstance(limit, int) else limit).otherwise(F.lit((1 << 31) - 2)).cast("int")
        # a chapter's words are known from where it was made
        parts = resplit(t.withColumn("__limit", bound).withColumn("__known", F.col("word_count")), F.col("__limit"), "content", F.col("__known"))
        return parts.select("book_id", F.concat("path", F.array("part")).alias("path"), "title", "content", "word_count")

    for _ in range(3):
        t = split(t, F.col("word_count") > most, most)
        half = most // 2
        large = F.col("word_count") > half
        more = F.when(large, F.greatest(F.lit(2), F.floor(F.col("word_count") / half)) - 1).otherwise(0)
        before = Window.partitionBy("book_id").orderBy(F.col("word_count").desc(), "path").rowsBetween(Window.unboundedPreceding, -1)
        t = t.withColumn("__count", F.count("*").over(book) + F.coalesce(F.sum(more).over(before), F.lit(0)))
        t = split(t, large & (F.col("__count") < fewest), half)
        t = t.withColumn("__median", F.median(F.when(F.col("word_count") > 0, F.col("word_count"))).over(book)).withColumn("__n", F.count("*").over(book))
        outlier = (F.col("__n") >= 2) & (F.col("__median") > 0) & (F.col("word_count") > F.col("__median") * ratio)
        t = split(t, F.coalesce(outlier, F.lit(False)), F.greatest(F.lit(LEAST_SPLIT), F.floor(F.col("__median") * 2)).cast("int"))
    number = F.row_number().over(Window.partitionBy("book_id").orderBy("path"))
    t = t.select("book_id", number.alias("chapter_number"), "title", "content", "word_count")
    return part_series(t)


def fallback_split(books: DataFrame, text: str = "text", size: int = 2500) -> DataFrame:
    """Books (book_id, text) in fixed slices, held to the bounds of ``quality_resplit``."""
    slices = fixed_slices(books.select("book_id", text), size, text)
    return quality_resplit(slices.select("book_id", F.col("section_number").alias("chapter_number"), F.col("section_title").alias("title"), "content"))


def part_series(chapters: DataFrame) -> DataFrame:
    """Number again the titles that end in "(part k)", each root title from 1."""
    root = F.regexp_replace("title", r"(?: \(part \d+\))+$", "")
    t = chapters.withColumn("__root", root).withColumn("__parts", F.max((F.col("__root") != F.col("title")).cast("int")).over(Window.partitionBy("book_id", "__root")))
    k = F.row_number().over(Window.partitionBy("book_id", "__root").orderBy("chapter_number"))
    title = F.when((F.col("__parts") == 0) | (k == 1), F.col("__root")).otherwise(F.concat("__root", F.lit(" (part "), k, F.lit(")")))
    return t.withColumn("title", title).drop("__root", "__parts")


def sentence_packs(chapters: DataFrame, limit: int, text: str = "text") -> DataFrame:
    """Packs of whole sentences of at most ``limit`` estimated tokens, where they fit."""
    parts = F.filter(sentences(F.col(text)), lambda s: s != "")
    t = chapters.withColumn("__packs", _pack(parts, estimate_tokens, limit, " "))
    t = t.select(*[c for c in chapters.columns if c != text], F.posexplode("__packs").alias("i", "x"))
    return t.select(*[c for c in t.columns if c not in ("i", "x")], (F.col("i") + 1).alias("pack"), estimate_tokens(F.col("x.t")).alias("tokens"), F.col("x.t").alias("content"))


def paragraph_packs(text: Column, limit: int = MAX_TOKENS) -> Column:
    """Packs of whole paragraphs of at most ``limit`` estimated tokens, joined by a
    blank line; a paragraph above it becomes packs of its sentences.
    """
    paragraphs = F.filter(F.transform(F.split(text, r"\n(?U:\s)*\n"), strip), lambda p: p != "")

    def texts(group: Column) -> Column:
        parts = F.filter(F.transform(sentences(group[0]), strip), lambda s: s != "")
        by_sentence = F.transform(greedy(parts, estimate_tokens, limit), lambda g: F.array_join(g, " "))
        return F.when((F.size(group) == 1) & (estimate_tokens(group[0]) > limit), by_sentence).otherwise(F.array(F.array_join(group, "\n\n")))

    return F.flatten(F.transform(greedy(paragraphs, estimate_tokens, limit), texts))


def needs_splitting(text: Column, limit: int = MAX_TOKENS) -> Column:
    return estimate_tokens(text) > limit


def section_headers(chapters: DataFrame, keys: list[str], text: str = "text", patterns: tuple[str, ...] = ()) -> DataFrame:
    """The lines of the chapters with ``header``: whether a section starts there.

    A header has 3 to 80 characters and one of the forms; from the seventh line
    on it follows a blank line, and it isn't among numbered list items (two or
    more within three lines around it). Windows run within a chapter.
    """
    t = chapters.select(*keys, F.posexplode(F.split(text, "\n")).alias("line_index", "line"))
    t = t.withColumn("__s", strip(F.col("line")))
    order = Window.partitionBy(*keys).orderBy("line_index")
    numbered = F.col("__s").rlike(r"(?U)^\d+\.\d+").cast("int")
    near = F.coalesce(F.sum(numbered).over(order.rowsBetween(-3, 3)), F.lit(0)) - numbered
    form = F.lit(False)
    for p in (*patterns, "|".join(f"(?:{h})" for h in HEADERS)):
        form = form | F.col("__s").rlike(f"(?iU)^(?:{p})$")
    blank_before = F.coalesce(F.lag("__s").over(order), F.lit("")) == ""
    header = F.length("__s").between(3, 80) & form & ((F.col("line_index") <= 5) | blank_before) & (near < 2)
    title = strip(F.regexp_replace(F.regexp_replace(F.regexp_replace("__s", r"^#+(?U:\s)*", ""), r"[:.]+$", ""), r"(?U)\s+", " "))
    return t.select(*keys, "line_index", "line", header.alias("header"), F.when(header, F.substring(title, 1, 80)).alias("header_title"))


def section_contents(lines: DataFrame, keys: list[str], least: int = 50, preamble: int = 100) -> DataFrame:
    """(keys, at, title, content) of the sections that have ``least`` words; ``at`` orders them.

    What stands before a first header below the eleventh line is the section
    "Introduction", if it has ``preamble`` words.
    """
    order = Window.partitionBy(*keys).orderBy("line_index").rowsBetween(Window.unboundedPreceding, 0)
    t = lines.withColumn("at", F.sum(F.col("header").cast("int")).over(order))
    one = F.struct("line_index", F.when(~F.col("header"), F.col("line")).alias("line"))
    g = t.groupBy(*keys, "at").agg(F.max("header_title").alias("title"), F.array_sort(F.collect_list(one)).alias("l"), F.max("line_index").alias("last"))
    # a header is no part of its section, nor does it leave an empty line
    body = F.transform(F.filter("l", lambda x: x["line"].isNotNull()), lambda x: x["line"])
    g = g.withColumn("content", strip(F.array_join(body, "\n"))).withColumn("n", F.size(words(F.col("content"))))
    enough = F.when(F.col("at") > 0, F.col("n") >= least).otherwise((F.col("last") >= 10) & (F.col("n") >= preamble))
    return g.filter(enough).select(*keys, "at", F.coalesce("title", F.lit("Introduction")).alias("title"), "content")


def sections(chapters: DataFrame, keys: list[str], limit: int = MAX_TOKENS, patterns: tuple[str, ...] = (), text: str = "text") -> DataFrame:
    """Chapters (keys, title, text) in sections of about ``limit`` estimated tokens at most.

    (keys, parent_title, section_number, title, content, token_count, word_count,
    is_partial). A chapter within the limit is one section. A larger one is cut at
    its headers, if that gives two sections or more, and what is too large then
    at paragraphs, in parts with numbered titles.
    """
    c = chapters.select(*keys, F.coalesce("title", F.lit("Untitled")).alias("title"), F.coalesce(text, F.lit("")).alias("text"))
    small = c.filter(~needs_splitting(F.col("text"), limit)).select(*keys, F.col("title").alias("parent_title"), F.lit(0).alias("at"), "title", F.col("text").alias("content"), F.lit(True).alias("whole"))
    large = c.filter(needs_splitting(F.col("text"), limit))
    headed = section_contents(section_headers(large, keys, "text", patterns), keys)
    headed = headed.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).filter("__n > 1").drop("__n")
    several = headed.select(*keys).distinct()
    by_header = headed.join(large.select(*keys, F.col("title").alias("parent_title")), keys)
    by_header = by_header.select(*keys, "parent_title", "at", "title", "content", (~needs_splitting(F.col("content"), limit)).alias("whole"))
    rest = large.join(several, keys, "left_anti").select(*keys, F.col("title").alias("parent_title"), F.lit(0).alias("at"), "title", F.col("text").alias("content"), F.lit(False).alias("whole"))
    each = small.unionByName(by_header).unionByName(rest)
    parts = F.when(F.col("whole"), F.array("content")).otherwise(paragraph_packs(F.col("content"), limit))
    t = each.select(*keys, "parent_title", "at", "title", "whole", F.posexplode(parts).alias("i", "content"))
    t = t.withColumn("section_number", F.row_number().over(Window.partitionBy(*keys).orderBy("at", "i")))
    title = F.when(F.col("whole"), F.col("title")).otherwise(F.concat("title", F.lit(" (Part "), F.col("i") + 1, F.lit(")")))
    return t.select(*keys, "parent_title", "section_number", title.alias("title"), "content", estimate_tokens(F.col("content")).alias("token_count"), F.size(words(F.col("content"))).alias("word_count"), (~F.col("whole")).alias("is_partial"))


_PIECE = "array<struct<t:string,kind:string,n:int>>"
#: The mark that cuts pieces apart and its escape; both are escaped in the text.
_MARK, _ESCAPE = "\x01", "\x02"


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_MARK), F.lit(_ESCAPE + "a"))


def _unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_ESCAPE + "a"), F.lit(_MARK)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE))


def pieces(text: Column, limit: int, separators: tuple[tuple[str, str], ...] = SEPARATORS, length: Callable[[Column], Column] | None = None) -> Column:
    """array<struct<t, kind, n>> of the pieces of at most ``limit`` words, in order; their texts make up ``text``.

    By the coarsest separator that divides, one level for each, unrolled: a piece
    that is too large goes on to the next. A separator stays with the piece
    after it. ``kind`` is that of the last separator but "word" that cut the piece
    out, "word" if there is none. ``length`` measures a piece instead of words; n is what it gives.
    """
    size = length or (lambda p: F.size(words(p)))
    out = bind(_escaped(text), lambda t: F.array(F.struct(t.alias("t"), F.lit("word").alias("kind"), size(t).alias("n"))).cast(_PIECE))
    for regex, kind in separators:

        def level(p: Column) -> Column:  # called before the loop goes on
            pattern, separator = regex, kind
            parts = F.filter(F.split(F.regexp_replace(p["t"], f"(?U)({pattern})", f"{_MARK}$1"), _MARK), lambda x: x != "")
            of = p["kind"] if separator == "word" else F.lit(separator)

            def cut(found: Column) -> Column:
                return F.when(F.size(found) < 2, F.array(p).cast(_PIECE)).otherwise(F.transform(found, lambda x: F.struct(x.alias("t"), of.alias("kind"), size(x).alias("n"))).cast(_PIECE))

            return F.when(p["n"] <= limit, F.array(p).cast(_PIECE)).otherwise(bind(parts, cut))

        out = F.flatten(F.transform(out, level))
    return F.transform(out, lambda p: F.struct(_unescaped(p["t"]).alias("t"), p["kind"].alias("kind"), p["n"].alias("n")))


def recursive_split(
    chapters: DataFrame,
    limit: int = 10000,
    overlap: int = 200,
    least: int = 500,
    separators: tuple[tuple[str, str], ...] = SEPARATORS,
    text: str = "text",
) -> DataFrame:
    """(..., chunk_index, chunk, start_index, end_index, chunk_words, separator).

    Pieces of at most ``limit`` words; each takes the last ``overlap`` words of the one
    before it to its front; then from the first on, a chunk of under ``least``
    words takes the next, joined by a line end. Blank pieces are left out; the
    positions are those of the pieces in the text.
    """
    keys = [c for c in chapters.columns if c != text]
    t = chapters.select(*keys, F.posexplode(pieces(F.coalesce(text, F.lit("")), limit, separators)).alias("__i", "__x"))
    order = Window.partitionBy(*keys).orderBy("__i")
    t = t.withColumn("__end", F.sum(F.length("__x.t")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.filter(F.col("__x.n") > 0).select(*keys, "__i", F.col("__x.t").alias("t"), F.col("__x.kind").alias("kind"), (F.col("__end") - F.length("__x.t")).alias("b"), F.col("__end").alias("e"), F.col("__x.n").alias("n"))
    if overlap:
        tail = bind(words(F.col("t")), lambda w: F.array_join(F.when(F.size(w) > overlap, F.slice(w, -overlap, overlap)).otherwise(w), " "))
        t = t.withColumn("__tail", tail)
        t = t.withColumn("__before", F.lag("__tail").over(order)).withColumn("__more", F.lag(F.least("n", F.lit(overlap))).over(order))
        grown = F.when(F.col("__before").isNotNull(), F.concat("__before", F.lit(" "), "t")).otherwise(F.col("t"))
        start = F.when(F.col("__before").isNotNull(), F.greatest(F.lit(0), F.col("b") - F.length("__before") - 1)).otherwise(F.col("b"))
        t = t.select(*keys, "__i", grown.alias("t"), "kind", start.alias("b"), "e", (F.col("n") + F.coalesce("__more", F.lit(0))).alias("n"))
    one = F.struct("__i", "t", "kind", "b", "e", "n")
    g = t.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("c"))
    g = g.withColumn("__starts", group_starts(F.transform("c", lambda x: x["n"]), lambda held, x: held < least))
    g = g.select(*keys, F.posexplode(cut_at(F.col("c"), F.col("__starts"))).alias("chunk_index", "g"))
    return g.select(
        *keys,
        "chunk_index",
        F.array_join(F.transform("g", lambda x: x["t"]), "\n").alias("chunk"),
        F.get("g", F.lit(0))["b"].alias("start_index"),
        F.element_at("g", -1)["e"].alias("end_index"),
        F.aggregate("g", F.lit(0), lambda n, x: n + x["n"]).alias("chunk_words"),
        F.get("g", F.lit(0))["kind"].alias("separator"),
    )


def chapter_aware_split(chapters: DataFrame, target: int = IDEAL_WORDS, least: int = LEAST_WORDS, overlap: int = 200, text: str = "text") -> DataFrame:
    """``recursive_split`` by separators that know chapters, with sizes of chapters."""
    return recursive_split(chapters, target, overlap, least, CHAPTER_SEPARATORS, text)


def force_split(w: Column, size: int) -> Column:
    """Slices of ``size`` words, the last one shorter."""
    return F.when(F.size(w) == 0, F.array().cast("array<array<string>>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(w), F.lit(size)), lambda at: F.slice(w, at, size)))


def split_stats(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Number and sizes of each text's chunks, and the chunks of each separator."""
    by_kind = chunks.groupBy(*keys, "separator").agg(F.count("*").alias("k"), F.sum("chunk_words").alias("s"), F.min("chunk_words").alias("lo"), F.max("chunk_words").alias("hi"))
    used = F.map_from_entries(F.array_sort(F.collect_list(F.struct("separator", "k"))))
    out = by_kind.groupBy(*keys).agg(F.sum("k").alias("total_chunks"), F.sum("s").alias("total_words"), F.min("lo").alias("min_chunk_size"), F.max("hi").alias("max_chunk_size"), used.alias("separators_used"))
    return out.withColumn("avg_chunk_size", F.col("total_words") / F.col("total_chunks"))


def validate_splits(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Whether each text's chunks have sizes of chapters: issues, recommendations and a score of 100 at most."""
    under, over = F.col("chunk_words") < LEAST_WORDS, F.col("chunk_words") > MOST_WORDS
    g = chunks.groupBy(*keys).agg(F.count("*").alias("total_chunks"), F.sum("chunk_words").alias("total_words"), F.sum(under.cast("int")).alias("undersized_count"), F.sum(over.cast("int")).alias("oversized_count"))
    g = g.withColumn("avg_chunk_size", F.col("total_words") / F.col("total_chunks")).withColumn("expected_chapters", F.greatest(F.lit(1).cast("long"), F.floor(F.col("total_words") / IDEAL_WORDS)))
    avg, n = F.col("avg_chunk_size"), F.col("total_chunks")
    count = F.concat(n.cast("string"), F.lit(") for word count ("), F.col("total_words").cast("string"), F.lit(")"))
    rules = [
        (avg < LEAST_WORDS, F.concat(F.lit("Average chunk size ("), F.format_string("%.0f", F.bround(avg, 0)), F.lit(f") below target ({LEAST_WORDS})")), "Consider merging small chapters"),
        (avg > MOST_WORDS, F.concat(F.lit("Average chunk size ("), F.format_string("%.0f", F.bround(avg, 0)), F.lit(f") above target ({MOST_WORDS})")), "Consider splitting large chapters"),
        (F.col("undersized_count") > 0, F.concat(F.col("undersized_count").cast("string"), F.lit(" chunks below minimum size")), None),
        (F.col("oversized_count") > 0, F.concat(F.col("oversized_count").cast("string"), F.lit(" chunks above maximum size")), None),
        (n > F.col("expected_chapters") * 2, F.concat(F.lit("Too many chunks ("), count), "Possible over-fragmentation"),
        ((n < F.floor(F.col("expected_chapters") / 2)) & (F.col("expected_chapters") > 2), F.concat(F.lit("Too few chunks ("), count), "Possible under-detection"),
    ]
    issues = F.array_compact(F.array(*[F.when(c, text) for c, text, _ in rules]))
    advice = F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, _, r in rules if r]))
    g = g.withColumn("issues", issues).withColumn("recommendations", advice)
    score = F.lit(100) - F.size("issues") * 10 - F.col("undersized_count") * 5 - F.col("oversized_count") * 5
    return g.withColumn("valid", F.size("issues") == 0).withColumn("quality_score", F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int"))


def with_overlap(chunks: DataFrame, keys: list[str], overlap: int = 200) -> DataFrame:
    """Prepend to each chunk the last ``overlap`` words of the one before it."""
    before = F.lag("chunk").over(Window.partitionBy(*keys).orderBy("chunk_index"))
    w = words(F.coalesce(before, F.lit("")))
    tail = F.array_join(F.when(F.size(w) > overlap, F.slice(w, -overlap, overlap)).otherwise(w), " ")
    return chunks.withColumn("chunk", F.when(tail != "", F.concat(tail, F.lit(" "), F.col("chunk"))).otherwise(F.col("chunk")))


#: Separators of chunks by characters, coarse to fine; fixed values.
CHAR_SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def char_pieces(text: str, size: int, separators: tuple[str, ...] = CHAR_SEPARATORS, length: Callable[[str], int] = len) -> list[str]:
    """Pieces of a text of ``size`` at most, where its separators allow.

    The first separator that the text holds cuts it; pieces are joined again while
    they fit, and one that is too large goes on to the finer separators, or stays
    as it is where there are none.
    """
    at = next((i for i, x in enumerate(separators) if x == "" or x in text), None)
    sep = separators[-1] if at is None else separators[at]
    finer = () if at is None or sep == "" else separators[at + 1 :]
    out: list[str] = []
    held = ""
    for part in text.split(sep) if sep else text:
        if length(held + sep + part) <= size:
            held = f"{held}{sep}{part}" if held else part
            continue
        out += [held] if held else []
        held = ""
        if length(part) <= size:
            held = part
        elif finer:
            out += char_pieces(part, size, finer, length)
        else:
            out.append(part)
    return out + ([held] if held else [])


def split_chars(chapters: DataFrame, size: int, separators: tuple[str, ...] = CHAR_SEPARATORS, length: Callable[[str], int] = len, text: str = "text") -> DataFrame:
    """(..., chunk_index, chunk, start_pos, end_pos, word_count) of the chunks of every text.

    A recursion over the text with a length function of the caller's: on Arrow
    batches in Python. A chunk's place is searched for from the end of the one before.
    """
    import pandas as pd

    kind = "array<struct<chunk:string,start_pos:int,end_pos:int>>"

    def cut(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[dict]:
            rows, at = [], 0
            for c in char_pieces(t or "", size, separators, length):
                found = t.find(c, at)
                start = at if found < 0 else found
                at = start + len(c)
                rows.append({"chunk": c, "start_pos": start, "end_pos": at})
            return rows

        return texts.map(one)

    # annotations are names here, so the kind of function is given
    chunks = F.pandas_udf(cut, kind, F.PandasUDFType.SCALAR)(F.coalesce(text, F.lit("")))
    keys = [c for c in chapters.columns if c != text]
    return chapters.select(*keys, F.posexplode(chunks).alias("chunk_index", "x")).select(*keys, "chunk_index", "x.*", F.size(words(F.col("x.chunk"))).alias("word_count"))

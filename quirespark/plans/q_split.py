"""Splitting of long chapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lines as ln
from ..functions.folds import bind
from ..functions.text import estimate_tokens
from ..operators import detection, merging, splitting, toc
from ..sources.tables import document_chapters, read

_W = "list_filter(regexp_split_to_array({}, '\\s+'), lambda w: w <> '')"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text")


def fixed_size_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.fixed_slices(_docs(spark, sf_dir), 250)


def sentence_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = splitting.sentence_packs(_docs(spark, sf_dir), 300)
    return p.select("doc_id", "pack", "tokens", F.sha2("content", 256).alias("content_hash"))


def resplit_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a blank line after every third line, at most 120 words a part."""
    def spaced(lines: Column) -> Column:
        return F.array_join(F.transform(lines, lambda x, i: F.when((i % 3 == 2) & (i < F.size(lines) - 1), F.concat(x, F.lit("\n"))).otherwise(x)), "\n")

    # not by a search for three lines, which goes through a long line once for each of its characters
    d = _docs(spark, sf_dir).withColumn("text", bind(F.split("text", "\n"), spaced)).withColumn("title", F.lit("T"))
    r = splitting.resplit(d, 120)
    return r.select("doc_id", "part", "title", "word_count", F.sha2("content", 256).alias("content_hash"))


def recursive_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = splitting.recursive_split(_docs(spark, sf_dir), 150, 20, 60)
    return c.select("doc_id", "chunk_index", "chunk_words", "start_index", "end_index", "separator", F.sha2("chunk", 256).alias("chunk_hash"))


def chapter_aware_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = splitting.chapter_aware_split(_docs(spark, sf_dir), 200, 80, 10)
    return c.select("doc_id", "chunk_index", "chunk_words", "separator", F.sha2("chunk", 256).alias("chunk_hash"))


def recursive_split_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = splitting.split_chars(_docs(spark, sf_dir), 400)
    return c.select("doc_id", "chunk_index", "start_pos", "end_pos", "word_count", F.sha2("chunk", 256).alias("chunk_hash"))


#: Stands around each text, the same on both sides.
HEAD, FOOT = "## Opening: \n", "\n\nKey  Points:\n1.1 One\n1.2 Two\n1.3 Three\n\n2.1 Second Part\n"
_TOKENS = 200


def _headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit(HEAD), "text", F.lit(FOOT), "text")
    return _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("Chapter "), "doc_id").alias("title"), text.alias("text"))


def section_header_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = splitting.section_headers(_headed(spark, sf_dir), ["doc_id"])
    return h.filter("header").select("doc_id", "line_index", "header_title")


def win_section_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = splitting.section_contents(splitting.section_headers(_headed(spark, sf_dir), ["doc_id"]), ["doc_id"])
    return c.select("doc_id", "at", "title", F.sha2("content", 256).alias("content_hash"))


def needs_splitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _headed(spark, sf_dir).filter(splitting.needs_splitting(F.col("text"), _TOKENS)).select("doc_id", estimate_tokens(F.col("text")).cast("long").alias("tokens"))


def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of documents with headers, as texts for models: parent, number, title, sizes."""
    t = splitting.sections(_headed(spark, sf_dir), ["doc_id"], _TOKENS)
    return t.select("doc_id", "parent_title", "section_number", "title", "token_count", "word_count", "is_partial", F.sha2("content", 256).alias("content_hash"))


def paragraph_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return d.select("doc_id", F.posexplode(splitting.paragraph_packs(F.col("text"), 100000)).alias("i", "content")).select("doc_id", (F.col("i") + 1).alias("pack"), F.length("content").alias("chars"), F.sha2("content", 256).alias("content_hash"))


def validate_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks of their source's text, ten words counted for one."""
    d = document_chapters(spark, sf_dir).select("book_id", (F.col("word_count") * 10).alias("chunk_words"))
    v = splitting.validate_splits(d, ["book_id"])
    return v.select("book_id", "total_chunks", "total_words", "undersized_count", "oversized_count", "expected_chapters", "valid", "quality_score", F.array_join("issues", "; ").alias("issues"), F.array_join("recommendations", "; ").alias("recommendations"))


def quality_resplit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chapters of books of ten."""
    d = _docs(spark, sf_dir).select(F.floor(F.col("doc_id") / 10).alias("book_id"), F.col("doc_id").alias("chapter_number"), F.lit("Section").alias("title"), F.col("text").alias("content"))
    q = splitting.quality_resplit(d, most=600, fewest=12)
    return q.select("book_id", "chapter_number", "title", "word_count", F.sha2("content", 256).alias("content_hash"))


def merge_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = document_chapters(spark, sf_dir, content=True).withColumnRenamed("text", "content").withColumn("word_count", F.col("word_count") * 10)
    m = merging.merge_chapters(d.select("book_id", "chapter_number", "title", "word_count", "content"))
    return m.select("book_id", "chapter_number", "title", "word_count", F.array_join("merged_from", " + ").alias("merged_from"), F.sha2("content", 256).alias("content_hash"))


def agg_degenerate_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd documents as the chapters found of their source."""
    d = document_chapters(spark, sf_dir)
    sizes = d.groupBy("book_id").agg(F.sum("word_count").alias("words"))
    return detection.degenerate(d.filter((F.col("word_count") < 150) | (F.col("word_count") > 3000)), sizes)


def extract_toc_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of contents that stand before each source's documents."""
    c = document_chapters(spark, sf_dir)
    line = F.concat(F.lit("Chapter "), "chapter_number", F.lit(": "), F.lit("The Road of "), "doc_id", F.lit(". . . . 7"))
    t = c.select("book_id", (F.col("chapter_number") * 2).alias("line_index"), line.alias("line"))
    return toc.titles(t).select("book_id", F.posexplode("titles").alias("at", "title"))


def join_toc_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of documents as candidates, matched to those of their source's contents."""
    c = document_chapters(spark, sf_dir)
    titles = c.filter("chapter_number <= 40").groupBy("book_id").agg(F.array_sort(F.collect_list("title")).alias("titles"))
    cand = c.filter("chapter_number <= 200").select("book_id", (F.col("chapter_number") * 20).alias("line_index"), "title", F.lit(ln.PATTERN).alias("match_type"))
    return toc.match_titles(cand, titles)


def join_packt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir).select("book_id", (F.col("chapter_number") * 20).alias("line_index"), "title")
    numbered = c.filter("line_index <= 400").select("book_id", F.col("line_index") + 5, F.upper("title"))
    return toc.with_numbered(c, numbered.toDF("book_id", "line_index", "title"))


def win_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = splitting.fixed_slices(_docs(spark, sf_dir), 250).select("doc_id", F.col("section_number").alias("chunk_index"), F.col("content").alias("chunk"))
    return splitting.with_overlap(c, ["doc_id"], 20)


def agg_split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = splitting.fixed_slices(_docs(spark, sf_dir), 250)
    return c.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum("section_words").alias("words"), F.round(F.avg("section_words"), 6).alias("avg_words"), F.min("section_words").alias("min_words"), F.max("section_words").alias("max_words"))


def _sql_text(x: str) -> str:
    return "'" + x.replace("\n", "' || chr(10) || '") + "'"


_CHAPTERS = "(SELECT source AS book_id, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n, text FROM documents)"
_CH = f"(SELECT book_id, n AS chapter_number, doc_id, text AS content, len({_W.format('text')})::INTEGER AS word_count, CASE doc_id % 3 WHEN 0 THEN 'Chapter ' || n || ': Topic ' || doc_id WHEN 1 THEN 'Section ' || n ELSE 'Summary' END AS title FROM {_CHAPTERS})"
_HEADED = f"(SELECT doc_id, {_sql_text(HEAD)} || text || {_sql_text(FOOT)} || text AS s FROM documents)"
_FORMS = " OR ".join(f"regexp_matches(st, '(?i)^(?:{p})$')" for p in splitting.HEADERS)
_LINES = f"""WITH l AS (SELECT doc_id, unnest(range(0, len(a))) AS i, a FROM (SELECT doc_id, string_split(s, chr(10)) AS a FROM {_HEADED})), t AS (SELECT doc_id, i, a[i + 1] AS line, regexp_replace(a[i + 1], '^\\s+|\\s+$', '', 'g') AS st FROM l),
m AS (SELECT *, regexp_matches(st, '^\\d+\\.\\d+')::INTEGER AS num, lag(st) OVER w AS prev, sum(regexp_matches(st, '^\\d+\\.\\d+')::INTEGER) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS around FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT *, length(st) BETWEEN 3 AND 80 AND ({_FORMS}) AND (i <= 5 OR prev = '') AND around - num < 2 AS header, substr(regexp_replace(regexp_replace(regexp_replace(regexp_replace(st, '^#+\\s*', ''), '[:.]+$', ''), '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), 1, 80) AS name FROM m)"""
_SECTIONS = f"""{_LINES}, g AS (SELECT *, sum(header::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS sec FROM h),
c AS (SELECT doc_id, sec, max(name) FILTER (header) AS title, max(i) AS last, regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT header), ''), '^\\s+|\\s+$', '', 'g') AS content FROM g GROUP BY doc_id, sec)"""
_SLICES = f"SELECT doc_id, i::INTEGER AS section_number, 'Section ' || i AS section_title, least(250, len(w) - (i - 1) * 250)::INTEGER AS section_words, array_to_string(w[(i - 1) * 250 + 1 : i * 250], ' ') AS content FROM (SELECT doc_id, w, unnest(range(1, (len(w) + 249) // 250 + 1)) AS i FROM (SELECT doc_id, {_W.format('text')} AS w FROM documents) WHERE len(w) > 0)"
CATALOG = {
    "fixed_size_split": (fixed_size_split, _SLICES),
    "sentence_pack_tokens": (
        sentence_pack_tokens,
        "WITH RECURSIVE s AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS l FROM documents), f AS (SELECT doc_id, 1 AS i, 1 AS pack, length(l[1]) // 4 AS n, l[1] AS t FROM s WHERE len(l) > 0 UNION ALL SELECT s.doc_id, f.i + 1, f.pack + CASE WHEN f.n + length(s.l[f.i + 1]) // 4 <= 300 THEN 0 ELSE 1 END, CASE WHEN f.n + length(s.l[f.i + 1]) // 4 <= 300 THEN f.n ELSE 0 END + length(s.l[f.i + 1]) // 4, CASE WHEN f.n + length(s.l[f.i + 1]) // 4 <= 300 THEN f.t || ' ' ELSE '' END || s.l[f.i + 1] FROM f JOIN s ON s.doc_id = f.doc_id WHERE f.i < len(s.l)) SELECT doc_id, pack, length(arg_max(t, i)) // 4 AS tokens, sha256(arg_max(t, i)) AS content_hash FROM f GROUP BY doc_id, pack",
    ),
    "section_header_match": (section_header_match, f"{_LINES} SELECT doc_id, i::INTEGER AS line_index, name AS header_title FROM h WHERE header"),
    "win_section_content": (
        win_section_content,
        f"{_SECTIONS} SELECT doc_id, sec::BIGINT AS at, coalesce(title, 'Introduction') AS title, sha256(content) AS content_hash FROM c WHERE CASE WHEN sec > 0 THEN len({_W.format('content')}) >= 50 ELSE last >= 10 AND len({_W.format('content')}) >= 100 END",
    ),
    "needs_splitting": (needs_splitting, f"SELECT doc_id, (length(s) // 4)::BIGINT AS tokens FROM {_HEADED} WHERE length(s) // 4 > {_TOKENS}"),
    "section_split": (section_split, ""),
    "paragraph_pack_tokens": (
        paragraph_pack_tokens,
        "SELECT doc_id, 1 AS pack, length(c)::INTEGER AS chars, sha256(c) AS content_hash FROM (SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), chr(10) || chr(10)) AS c FROM documents) WHERE c <> ''",
    ),
    "chapter_aware_split": (chapter_aware_split, ""),
    "recursive_split_chars": (recursive_split_chars, ""),
    "validate_splits": (
        validate_splits,
        f"""WITH g AS (SELECT book_id, count(*) AS n, sum(w)::BIGINT AS total, count(*) FILTER (w < 3000) AS under, count(*) FILTER (w > 15000) AS over FROM (SELECT book_id, word_count * 10 AS w FROM {_CH}) GROUP BY book_id),
e AS (SELECT *, total::DOUBLE / n AS avg, greatest(1, total // 8000)::BIGINT AS expected FROM g),
i AS (SELECT *, [CASE WHEN avg < 3000 THEN 'Average chunk size (' || printf('%.0f', avg) || ') below target (3000)' END, CASE WHEN avg > 15000 THEN 'Average chunk size (' || printf('%.0f', avg) || ') above target (15000)' END, CASE WHEN under > 0 THEN under || ' chunks below minimum size' END, CASE WHEN over > 0 THEN over || ' chunks above maximum size' END, CASE WHEN n > expected * 2 THEN 'Too many chunks (' || n || ') for word count (' || total || ')' END, CASE WHEN n < expected // 2 AND expected > 2 THEN 'Too few chunks (' || n || ') for word count (' || total || ')' END] AS a,
[CASE WHEN avg < 3000 THEN 'Consider merging small chapters' END, CASE WHEN avg > 15000 THEN 'Consider splitting large chapters' END, CASE WHEN n > expected * 2 THEN 'Possible over-fragmentation' END, CASE WHEN n < expected // 2 AND expected > 2 THEN 'Possible under-detection' END] AS r FROM e)
SELECT book_id, n AS total_chunks, total AS total_words, under::BIGINT AS undersized_count, over::BIGINT AS oversized_count, expected AS expected_chapters, len(list_filter(a, lambda x: x IS NOT NULL)) = 0 AS valid, greatest(0, least(100, 100 - 10 * len(list_filter(a, lambda x: x IS NOT NULL)) - 5 * under - 5 * over))::INTEGER AS quality_score, array_to_string(list_filter(a, lambda x: x IS NOT NULL), '; ') AS issues, array_to_string(list_filter(r, lambda x: x IS NOT NULL), '; ') AS recommendations FROM i""",
    ),
    "quality_resplit": (quality_resplit, ""),
    "merge_chapters": (merge_chapters, ""),
    "agg_degenerate_gate": (
        agg_degenerate_gate,
        f"SELECT c.book_id, count(*) AS chapters, count(*) FILTER (word_count < 100) AS tiny, sum(word_count)::BIGINT AS captured, count(*) > 1 AND count(*) FILTER (word_count < 100) * 2 > count(*) AND sum(word_count) * 2 < max(words) AS degenerate FROM {_CH} c JOIN (SELECT book_id, sum(word_count) AS words FROM {_CH} GROUP BY book_id) s ON s.book_id = c.book_id WHERE word_count < 150 OR word_count > 3000 GROUP BY c.book_id",
    ),
    "extract_toc_titles": (extract_toc_titles, f"SELECT book_id, (n - 1)::INTEGER AS at, 'The Road of ' || doc_id AS title FROM {_CHAPTERS} c WHERE n * 2 < 600 AND (SELECT count(*) FROM {_CHAPTERS} d WHERE d.book_id = c.book_id) >= 3"),
    "join_toc_fuzzy": (join_toc_fuzzy, ""),
    "join_packt_dedup": (
        join_packt_dedup,
        f"WITH c AS (SELECT book_id, (chapter_number * 20)::INTEGER AS line_index, title FROM {_CH}), k AS (SELECT book_id, line_index + 5 AS line_index, upper(title) AS title FROM c WHERE line_index <= 400) SELECT * FROM c WHERE line_index >= 1000 OR NOT EXISTS (SELECT 1 FROM k WHERE k.book_id = c.book_id AND lower(k.title) = lower(c.title)) UNION ALL SELECT * FROM k",
    ),
    "resplit_chapter": (resplit_chapter, ""),
    "recursive_split_words": (recursive_split, ""),
    "win_overlap": (win_overlap, f"SELECT doc_id, section_number AS chunk_index, CASE WHEN section_number > 1 THEN array_to_string(list_filter(regexp_split_to_array(p, ' '), lambda w: w <> '')[-20:], ' ') || ' ' ELSE '' END || content AS chunk FROM (SELECT *, lag(content) OVER (PARTITION BY doc_id ORDER BY section_number) AS p FROM ({_SLICES}))"),
    "agg_split_stats": (agg_split_stats, f"SELECT doc_id, count(*) AS chunks, sum(section_words)::BIGINT AS words, round(avg(section_words), 6) AS avg_words, min(section_words) AS min_words, max(section_words) AS max_words FROM ({_SLICES}) GROUP BY doc_id"),
}

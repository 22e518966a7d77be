"""Tables, sinks, metadata, anchors and checks against topic shifts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lines import EXPLICIT_TYPE, PATTERN, TOC
from ..operators import anchors, library, metadata, reports, semantic, storage
from ..sources.tables import document_chapters, read


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("id"),
        F.when(k % 4 != 0, F.col("c_name")).alias("title"),
        F.when(k % 3 == 0, F.concat(F.lit("/in/b"), k % 100, F.lit(".epub"))).otherwise(F.concat(F.lit("b"), k % 50, F.lit(".pdf"))).alias("source_file"),
        F.when(k % 2 == 0, "completed").otherwise("processing").alias("processing_status"),
        k.cast("long").alias("word_count"),
        F.lit(None).cast("string").alias("author"),
    )


_BOOKS = "(SELECT c_custkey AS id, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS title, CASE WHEN c_custkey % 3 = 0 THEN '/in/b' || (c_custkey % 100) || '.epub' ELSE 'b' || (c_custkey % 50) || '.pdf' END AS source_file, CASE WHEN c_custkey % 2 = 0 THEN 'completed' ELSE 'processing' END AS processing_status, c_custkey::BIGINT AS word_count, NULL::VARCHAR AS author FROM customer)"


def sink_insert_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _books(spark, sf_dir)
    new = b.filter("id % 5 = 0").select((F.col("id") + 7).alias("id"), "title", "source_file", "author")
    return storage.insert_books(b, new).drop("author")


def sink_update_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _books(spark, sf_dir)
    return storage.update_status(b, b.filter("id % 7 = 0").select("id", F.lit("failed").alias("processing_status"))).select("id", "processing_status")


def sink_checkpoint_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _books(spark, sf_dir)
    return storage.delete_keys(b, b.filter("id % 7 = 0"), "id").select("id")


def src_processed_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.processed_filenames(_books(spark, sf_dir))


def src_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.newest_books(_books(spark, sf_dir).withColumn("added_date", F.col("id") % 10)).select("id", "added_date")


def src_chapters_by_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.chapters_of(document_chapters(spark, sf_dir), "src0").select("book_id", "chapter_number", "word_count")


def _embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 3 == 0, F.col("vec_id").cast("double")).alias("embedding"))
    return e.withColumn("embedding_model", F.when(F.col("embedding").isNotNull(), F.lit("old")))


def src_unembedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.unembedded(_embedded(spark, sf_dir)).select("id")


def sink_embedding_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _embedded(spark, sf_dir)
    return storage.update_embeddings(e, e.filter("id % 2 = 0").select("id", (F.col("id") * 0.5).alias("embedding"), F.lit("new").alias("embedding_model")))


def _book_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("book_id"), F.col("o_orderkey").alias("chapter_number"), F.floor(F.col("o_totalprice") / 20).cast("int").alias("word_count"))


def sink_reingest_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books after every third has got its chapters anew, with a word more in each."""
    c = _book_chapters(spark, sf_dir)
    books, _ = storage.replace_chapters(_books(spark, sf_dir), c, c.filter("book_id % 3 = 0").withColumn("word_count", F.col("word_count") + 1))
    return books.select("id", "word_count", "processing_status")


def sink_apply_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters and backed-up chapters, counted by book, after one chapter has taken in all."""
    c = _book_chapters(spark, sf_dir)
    merged = c.filter("book_id % 2 = 1").groupBy("book_id").agg(F.min("chapter_number").alias("chapter_number"), F.sum("word_count").cast("int").alias("word_count"))
    books, chapters, backup = storage.apply_merges(_books(spark, sf_dir), c, merged)
    n = chapters.groupBy("book_id").agg(F.count("*").alias("chapters"))
    old = backup.groupBy("book_id").agg(F.count("*").alias("saved"))
    j = books.join(n.withColumnRenamed("book_id", "id"), "id").join(old.withColumnRenamed("book_id", "id"), "id", "left")
    return j.select("id", "word_count", "processing_status", "chapters", F.coalesce("saved", F.lit(0)).alias("saved"))


def _section_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source in chapters of up to three sections."""
    c = document_chapters(spark, sf_dir)
    n = F.floor((F.col("chapter_number") - 1) / 3).cast("int") + 1
    return c.select("book_id", n.alias("chapter_number"), F.concat(F.lit("Part "), n).alias("parent_title"), ((F.col("chapter_number") - 1) % 3 + 1).cast("int").alias("section_number"), "title", (F.col("word_count") * 2).alias("token_count"), "word_count")


def agg_section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.section_counts(_section_table(spark, sf_dir))


def render_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.render_index(_section_table(spark, sf_dir), ["book_id", "chapter_number"])


def sink_markdown_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir, content=True).withColumnRenamed("text", "content")
    return storage.chapter_files(c).select("book_id", "path", "content_hash")


def sink_markdown_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _section_table(spark, sf_dir).withColumn("content", F.lit("body")).withColumn("is_partial", F.col("section_number") == 2)
    return storage.section_files(t).select("book_id", "path", F.sha2("body", 256).alias("body_hash"))


_FILE = "CASE doc_id % 4 WHEN 0 THEN '/x/Deep Work - 2nd Edition (2019).epub' WHEN 1 THEN 'a.b/The  Long   Road.v2.pdf' WHEN 2 THEN '(draft).txt' ELSE 'plain' END"
_LEAD = "CASE doc_id % 3 WHEN 0 THEN 'Contents of it all' || chr(10) || 'A Title Of Some Length' || chr(10) || 'by Jane Mary Doe' || chr(10) WHEN 1 THEN 'short' || chr(10) || 'Author: John Smith' || chr(10) ELSE 'Preface and more' || chr(10) || 'John Smith' || chr(10) END"


def metadata_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", F.expr(_FILE.replace("chr(10)", "'\\n'")).alias("source_file"), F.concat(F.expr(_LEAD.replace("chr(10)", "'\\n'")), F.lit("x")).alias("text"))
    return metadata.extract(d).select("doc_id", "title", "author", "language", "word_count", "processing_status")


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir).select("book_id", "chapter_number", "title", (F.col("word_count") * 8).alias("word_count"), (F.col("doc_id") * 30).alias("line_index"))
    b = read(spark, sf_dir, "documents").filter("source <> 'src1'").select(F.col("source").alias("book_id"), (F.col("doc_id") * 77).alias("line_index"), ((F.col("doc_id") % 10) / 10.0).alias("similarity"))
    return semantic.validate(c, b)


def semantic_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("book_id", "chapter_number", "has_boundary", F.round("confidence", 6).alias("confidence"), "merge_with_previous", "is_valid")


def agg_validation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = semantic.validation_stats(_checked(spark, sf_dir))
    return s.withColumn("avg_words", F.round("avg_words", 6)).withColumn("overall_confidence", F.round("overall_confidence", 6))


def semantic_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.recommendations(_checked(spark, sf_dir)).select("book_id", F.array_join("recommendations", "; ").alias("recommendations"))


def sentence_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), "text")
    return semantic.sentence_buffers(d, 60).select("book_id", "position", "line_index", "start_pos", F.sha2("text", 256).alias("text_hash"))


def join_title_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second lines of documents as titles, searched for in their documents."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), "text")
    c = d.select("book_id", F.lit(1).alias("chapter_number"), F.get(F.split("text", "\n"), F.lit(1)).alias("title"))
    return semantic.title_lines(c, d.select("book_id", F.posexplode(F.split("text", "\n")).alias("line_index", "line")))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir)
    kind = F.when(F.col("doc_id") % 3 == 0, EXPLICIT_TYPE).when(F.col("doc_id") % 3 == 1, TOC).otherwise(PATTERN)
    return c.select("book_id", "chapter_number", (F.col("chapter_number") * 10).alias("line_index"), "title", kind.alias("match_type"), ((F.col("doc_id") % 11) / 10.0).alias("confidence"))


def agg_anchor_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.detection_method(_candidates(spark, sf_dir))


def _split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir)
    href = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("a.xhtml#"), "doc_id")).otherwise(F.concat(F.lit("b"), "doc_id", F.lit(".xhtml")))
    return c.select("book_id", href.alias("full_href"), (F.col("chapter_number") % 4).alias("depth"))


def agg_toc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.anchor_counts(_split_points(spark, sf_dir))


def reliable_anchor_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _candidates(spark, sf_dir)
    return anchors.reliable(c.filter(F.col("chapter_number") % 4 <= F.length("book_id") % 2), _split_points(spark, sf_dir))


def join_anchor_nonoverlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _candidates(spark, sf_dir).select("book_id", "line_index", "title", "match_type")
    a = c.filter("line_index % 40 = 0").withColumn("title", F.lit("Anchor"))
    return anchors.with_candidates(a, c, c.select("book_id").distinct().select("book_id", (F.col("book_id") == "src2").alias("reliable")))


def join_split_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _split_points(spark, sf_dir)
    return anchors.split_anchors(s, s.filter("depth < 2").select("book_id", "full_href", F.length("full_href").alias("line_index")))


def win_sequential_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir)
    pairs = c.select("book_id", (F.col("chapter_number") * 3).alias("line_index"), (F.col("chapter_number") % 7).cast("int").alias("number"), "title")
    return anchors.number_chains(pairs)


def fn_fingerprint_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", anchors.fingerprint_valid(F.col("text"), F.substring("text", 4, 60), F.when(F.col("doc_id") % 2 == 0, 3).otherwise(2)).alias("valid"))


def join_anchor_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words 3 and 4 of each text, searched for around a hint."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), F.coalesce("text", F.lit("")).alias("text"))
    w = F.filter(F.split("text", " "), lambda x: x != "")
    a = d.select("book_id", F.array_join(F.slice(w, 3, 2), " ").alias("fingerprint"), F.floor(F.length("text") / 2).alias("hint"), F.lit(0).alias("stored_line"))
    return anchors.resolve_lines(a, d).select("book_id", "line_index")


def penalties_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    d = read(spark, sf_dir, "documents").select(i, (i % 2 == 0).alias("in_code_block"), (i % 3 == 0).alias("preceded_by_blank"), (i % 5 == 0).alias("followed_by_prose"), (i % 4).alias("nearby_similar_lines"))
    return d.select("doc_id", F.array_join(reports.penalties(), "; ").alias("penalties"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = library.profile(document_chapters(spark, sf_dir))
    return p.withColumn("quality_score", (F.col("total_words") % 100).cast("int")).withColumn("metadata", F.lit(0.75)).withColumn("warnings", F.array(F.lit("one"), F.lit("two"))).withColumn("info", F.array().cast("array<string>"))


def quality_report_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_report(_scored(spark, sf_dir))


def is_valid_needs_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir).withColumn("warnings", F.when(F.col("total_words") % 3 == 0, F.col("warnings")).otherwise(F.col("info")))
    f = reports.flags(s.withColumn("validation_valid", F.col("total_words") % 5 != 0).withColumn("confidence", (F.col("total_words") % 10) / 10))
    return f.select("book_id", "is_valid", "needs_review")


def validator_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chapters with a hundred times their words."""
    c = document_chapters(spark, sf_dir).withColumn("word_count", F.col("word_count") * 100)
    e = c.groupBy("book_id").agg((F.count("*") + F.length("book_id") - 3).alias("expected_chapters"))
    m = reports.validation_messages(c, e)
    return m.select("book_id", "expected_chapters", "actual_chapters", F.array_join("warnings", "; ").alias("warnings"), F.array_join("errors", "; ").alias("errors"), "is_valid", F.array_join("recommendations", "; ").alias("recommendations"))


def sort_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.worst_first(_scored(spark, sf_dir), 75).select("book_id", "quality_score")


def sort_problematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.problematic(library.profile(document_chapters(spark, sf_dir))).select("book_id", "total_chapters")


def sink_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.library_json(_scored(spark, sf_dir).select("book_id", "quality_score", "total_words"))


_CH = "(SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n, doc_id, text, CASE doc_id % 3 WHEN 0 THEN 'Chapter ' || row_number() OVER (PARTITION BY source ORDER BY doc_id) || ': Topic ' || doc_id WHEN 1 THEN 'Section ' || row_number() OVER (PARTITION BY source ORDER BY doc_id) ELSE 'Summary' END AS title, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::INTEGER AS w FROM documents)"
_BC = "(SELECT o_custkey AS book_id, o_orderkey AS chapter_number, floor(o_totalprice / 20)::INTEGER AS word_count FROM orders)"
_SEC = f"(SELECT book_id, ((n - 1) // 3 + 1)::INTEGER AS c, 'Part ' || ((n - 1) // 3 + 1) AS parent, ((n - 1) % 3 + 1)::INTEGER AS s, title, w * 2 AS tokens, w FROM {_CH})"
_SLUG = "substr(lower(regexp_replace(regexp_replace(regexp_replace({}, '[^\\p{{L}}\\p{{N}}_\\s\\-.]', '', 'g'), '\\s+', '-', 'g'), '-+', '-', 'g')), 1, 100)"
_SP = f"(SELECT book_id, CASE WHEN doc_id % 2 = 0 THEN 'a.xhtml#' || doc_id ELSE 'b' || doc_id || '.xhtml' END AS full_href, n % 4 AS depth FROM {_CH})"
_CA = f"(SELECT book_id, n AS chapter_number, n * 10 AS line_index, title, CASE doc_id % 3 WHEN 0 THEN {EXPLICIT_TYPE} WHEN 1 THEN {TOC} ELSE {PATTERN} END AS match_type, (doc_id % 11) / 10.0::DOUBLE AS confidence FROM {_CH})"
_VAL = f"""WITH c AS (SELECT book_id, n AS chapter_number, title, w * 8 AS words, doc_id * 30 AS l FROM {_CH}), b AS (SELECT source AS book_id, doc_id * 77 AS l, (doc_id % 10) / 10.0::DOUBLE AS s FROM documents WHERE source <> 'src1'),
j AS (SELECT c.*, (SELECT arg_min(b.l, (abs(b.l - c.l), b.l)) FROM b WHERE b.book_id = c.book_id) AS bl FROM c),
k AS (SELECT j.*, abs(j.l - j.bl) AS d, b.s FROM j LEFT JOIN b ON b.book_id = j.book_id AND b.l = j.bl),
v AS (SELECT *, coalesce(d <= 50, false) AS has_boundary, CASE WHEN bl IS NULL THEN round(greatest(0, least(1, 0.5 + CASE WHEN words BETWEEN 2000 AND 20000 THEN 0.2 WHEN words < 1000 THEN -0.2 WHEN words > 25000 THEN -0.1 ELSE 0 END + CASE WHEN regexp_matches(title, '(?i)^(Chapter|Part|Lesson|Module|Unit)\\s+\\d+') THEN 0.2 WHEN regexp_matches(title, '^Section\\s+\\d+$') THEN -0.3 ELSE 0 END))::DOUBLE, 6) WHEN d <= 50 THEN 0.5::DOUBLE + 0.5::DOUBLE * (1 - d / 50.0::DOUBLE) * (1 - s) ELSE 0.3::DOUBLE END AS confidence FROM k),
w AS (SELECT *, words < 2000 AND NOT has_boundary AND chapter_number > 1 AS merge_with_previous, words >= 2000 AND (has_boundary OR confidence >= 0.5) AS is_valid FROM v)"""
CATALOG = {
    "sink_insert_book": (
        sink_insert_book,
        f"WITH n AS (SELECT id + 7 AS id, coalesce(title, 'Unknown') AS title, source_file, 'processing' AS processing_status, 0::BIGINT AS word_count FROM {_BOOKS} b WHERE id % 5 = 0) SELECT id, title, source_file, processing_status, word_count FROM {_BOOKS} b WHERE id NOT IN (SELECT id FROM n) UNION ALL SELECT * FROM n",
    ),
    "sink_update_status": (sink_update_status, f"SELECT id, CASE WHEN id % 7 = 0 THEN 'failed' ELSE processing_status END AS processing_status FROM {_BOOKS} b"),
    "sink_checkpoint_delete": (sink_checkpoint_delete, f"SELECT id FROM {_BOOKS} b WHERE id % 7 <> 0"),
    "src_processed_filenames": (src_processed_filenames, f"SELECT DISTINCT regexp_extract(source_file, '[^/]+$', 0) AS name FROM {_BOOKS} b WHERE processing_status = 'completed'"),
    "src_books": (src_books, f"SELECT id, id % 10 AS added_date FROM {_BOOKS} b ORDER BY 2 DESC, 1"),
    "src_chapters_by_book": (src_chapters_by_book, f"SELECT book_id, n AS chapter_number, w AS word_count FROM {_CH} WHERE book_id = 'src0'"),
    "src_unembedded": (src_unembedded, "SELECT vec_id AS id FROM embeddings WHERE vec_id % 3 <> 0"),
    "sink_embedding_update": (sink_embedding_update, "SELECT vec_id AS id, CASE WHEN vec_id % 2 = 0 THEN vec_id * 0.5::DOUBLE WHEN vec_id % 3 = 0 THEN vec_id::DOUBLE END AS embedding, CASE WHEN vec_id % 2 = 0 THEN 'new' WHEN vec_id % 3 = 0 THEN 'old' END AS embedding_model FROM embeddings"),
    "sink_reingest_replace": (sink_reingest_replace, f"SELECT id, coalesce((SELECT sum(word_count + 1) FROM {_BC} c WHERE c.book_id = id AND id % 3 = 0), word_count)::BIGINT AS word_count, processing_status FROM {_BOOKS} b"),
    "sink_apply_merges": (
        sink_apply_merges,
        f"SELECT b.id, CASE WHEN b.id % 2 = 1 THEN s.words ELSE b.word_count END::BIGINT AS word_count, CASE WHEN b.id % 2 = 1 THEN 'reprocessed' ELSE b.processing_status END AS processing_status, CASE WHEN b.id % 2 = 1 THEN 1 ELSE s.n END AS chapters, CASE WHEN b.id % 2 = 1 THEN s.n ELSE 0 END AS saved FROM {_BOOKS} b JOIN (SELECT book_id, count(*) AS n, sum(word_count) AS words FROM {_BC} GROUP BY book_id) s ON s.book_id = b.id",
    ),
    "agg_section_counts": (agg_section_counts, f"SELECT book_id, sum(n)::BIGINT AS section_count, count(*) FILTER (n > 1) AS split_chapters FROM (SELECT book_id, c, count(*) AS n FROM {_SEC} GROUP BY ALL) GROUP BY book_id"),
    "render_index": (
        render_index,
        f"SELECT book_id, c AS chapter_number, '---' || chr(10) || 'title: \"' || any_value(parent) || '\"' || chr(10) || 'chapter: ' || c || chr(10) || 'total_sections: ' || count(*) || chr(10) || 'total_tokens: ' || sum(tokens) || chr(10) || 'total_words: ' || sum(w) || chr(10) || '---' || chr(10) || chr(10) || '# ' || any_value(parent) || chr(10) || chr(10) || '**Chapter ' || c || '** | *' || count(*) || ' sections* | *' || format('{{:,}}', sum(w)::BIGINT) || ' words total*' || chr(10) || chr(10) || 'This chapter has been split into multiple sections for AI readability.' || chr(10) || chr(10) || '## Sections' || chr(10) || chr(10) || string_agg(s || '. [' || title || '](./' || {_SLUG.format("'0' || s || '-' || title || '.md'")} || ') (~' || format('{{:,}}', tokens) || ' tokens)', chr(10) ORDER BY s) AS body FROM {_SEC} GROUP BY book_id, c HAVING count(*) > 1",
    ),
    "sink_markdown_flat": (
        sink_markdown_flat,
        f"SELECT book_id, {_SLUG.format("CASE WHEN n < 10 THEN '0' || n ELSE left(n::VARCHAR, 2) END || '-' || title || '.md'")} AS path, sha256('# ' || title || chr(10) || chr(10) || '**Chapter ' || n || '**' || chr(10) || '*Word Count: ' || w || '*' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || text) AS content_hash FROM {_CH}",
    ),
    "sink_markdown_sections": (sink_markdown_sections, ""),
    "metadata_extract": (
        metadata_extract,
        f"SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Deep Work' WHEN 1 THEN 'The Long Road.v2' WHEN 2 THEN CASE doc_id % 3 WHEN 0 THEN 'A Title Of Some Length' WHEN 1 THEN 'Author: John Smith' ELSE 'Preface and more' END ELSE 'plain' END AS title, CASE doc_id % 3 WHEN 0 THEN 'Jane Mary Doe' ELSE 'John Smith' END AS author, 'en' AS language, len(list_filter(regexp_split_to_array({_LEAD} || 'x', '\\s+'), lambda w: w <> ''))::INTEGER AS word_count, 'processing' AS processing_status FROM documents",
    ),
    "semantic_validate": (semantic_validate, f"{_VAL} SELECT book_id, chapter_number, has_boundary, round(confidence, 6) AS confidence, merge_with_previous, is_valid FROM w"),
    "agg_validation_stats": (
        agg_validation_stats,
        f"{_VAL} SELECT book_id, count(*) AS total_chapters, count(*) FILTER (is_valid) AS valid_chapters, count(*) FILTER (has_boundary) AS aligned_chapters, count(*) FILTER (merge_with_previous) AS merge_candidates, round(avg(words), 6) AS avg_words, min(words) AS min_words, max(words) AS max_words, round(avg(confidence), 6) AS overall_confidence FROM w GROUP BY book_id",
    ),
    "semantic_recommendations": (semantic_recommendations, ""),
    "sentence_buffer": (sentence_buffer, ""),
    "join_title_line": (
        join_title_line,
        "WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents) SELECT doc_id AS book_id, 1 AS chapter_number, coalesce(CASE WHEN len(a) > 1 AND a[2] <> '' THEN list_position(list_transform(a, lambda x: contains(lower(x), lower(a[2]))), true) - 1 END, 0)::INTEGER AS line_index FROM l",
    ),
    "agg_anchor_method": (
        agg_anchor_method,
        f"SELECT book_id, CASE WHEN bool_and(confidence >= 0.7) THEN 'high' WHEN bool_or(confidence >= 0.7) THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN count(*) FILTER (match_type = {TOC}) * 2 > count(*) THEN 'toc' WHEN bool_or(match_type = {EXPLICIT_TYPE}) THEN 'pattern' ELSE 'fallback' END AS method FROM {_CA} GROUP BY book_id",
    ),
    "agg_toc_counts": (agg_toc_counts, f"SELECT book_id, count(*) FILTER (depth <= 2) AS chapter_count, count(*) FILTER (contains(full_href, '#')) AS anchor_count FROM {_SP} GROUP BY book_id"),
    "reliable_anchor_gate": (
        reliable_anchor_gate,
        f"WITH s AS (SELECT book_id, count(*) FILTER (depth = 0) AS t, count(*) FILTER (depth <= 1) AS u FROM {_SP} GROUP BY book_id), a AS (SELECT book_id, count(*) AS n FROM {_CA} WHERE chapter_number % 4 <= length(book_id) % 2 GROUP BY book_id) SELECT s.book_id, coalesce(n >= 3 AND CASE WHEN t > 0 THEN t ELSE u END > 0 AND n >= CASE WHEN t > 0 THEN t ELSE u END * 0.8, false) AS reliable FROM s LEFT JOIN a ON a.book_id = s.book_id",
    ),
    "join_anchor_nonoverlap": (
        join_anchor_nonoverlap,
        f"SELECT book_id, line_index, 'Anchor' AS title, match_type FROM {_CA} WHERE line_index % 40 = 0 UNION ALL SELECT book_id, line_index, title, match_type FROM {_CA} WHERE line_index % 40 <> 0 AND match_type <> {TOC} AND book_id <> 'src2'",
    ),
    "join_split_anchor": (join_split_anchor, f"SELECT book_id, full_href, depth, length(full_href)::INTEGER AS line_index FROM {_SP} WHERE depth < 2"),
    "win_sequential_chain": (win_sequential_chain, f"SELECT book_id, n::INTEGER AS number, (n * 3)::INTEGER AS line_index, title FROM {_CH} c WHERE n < 7 AND (SELECT count(*) FROM {_CH} d WHERE d.book_id = c.book_id) >= 3"),
    "fn_fingerprint_validate": (fn_fingerprint_validate, "SELECT doc_id, length(substr(text, 4, 50)) > 0 AND substr(text, CASE WHEN doc_id % 2 = 0 THEN 4 ELSE 3 END, length(substr(text, 4, 50))) = substr(text, 4, 50) AS valid FROM documents"),
    "join_anchor_fingerprint": (join_anchor_fingerprint, ""),
    "penalties_list": (
        penalties_list,
        "SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 2 = 0 THEN 'in_code_block (-0.5)' END, CASE WHEN doc_id % 3 <> 0 THEN 'no_blank_before (-0.2)' END, CASE WHEN doc_id % 5 <> 0 THEN 'no_prose_after (-0.3)' END, CASE WHEN doc_id % 4 >= 2 THEN 'list_item (-0.4)' END], lambda x: x IS NOT NULL), '; ') AS penalties FROM documents",
    ),
    "quality_report_md": (
        quality_report_md,
        f"WITH p AS (SELECT book_id, sum(w)::BIGINT AS t, count(*) AS n, avg(w) AS a, min(w)::BIGINT AS lo, max(w)::BIGINT AS hi, floor(sum(w) / 0.75::DOUBLE)::BIGINT AS k FROM {_CH} GROUP BY book_id), s AS (SELECT *, t % 100 AS q FROM p) SELECT book_id, '## Processing Quality Report' || chr(10) || chr(10) || '**Book ID:** ' || book_id || chr(10) || '**Quality Score:** ' || q || '/100 (' || CASE WHEN q >= 90 THEN 'Excellent' WHEN q >= 75 THEN 'Good' WHEN q >= 50 THEN 'Fair' ELSE 'Poor' END || ')' || chr(10) || chr(10) || '### Statistics' || chr(10) || '- Total Words: ' || format('{{:,}}', t) || chr(10) || '- Chapters Detected: ' || n || chr(10) || '- Avg Chapter Size: ' || format('{{:,}}', round_even(a, 0)::BIGINT) || ' words' || chr(10) || '- Min Chapter Size: ' || format('{{:,}}', lo) || ' words' || chr(10) || '- Max Chapter Size: ' || format('{{:,}}', hi) || ' words' || chr(10) || '- Estimated Tokens: ' || format('{{:,}}', k) || chr(10) || '- Metadata Completeness: 75%' || chr(10) || chr(10) || '### Warnings' || chr(10) || '- one' || chr(10) || '- two' || chr(10) || chr(10) || '### Info' || chr(10) || 'None' AS report FROM s",
    ),
    "is_valid_needs_review": (is_valid_needs_review, f"SELECT book_id, t % 5 <> 0 AND t % 100 >= 50 AS is_valid, t % 3 = 0 OR t % 10 < 7 OR t % 100 < 75 AS needs_review FROM (SELECT book_id, sum(w)::BIGINT AS t FROM {_CH} GROUP BY book_id)"),
    "validator_messages": (validator_messages, ""),
    "sort_quality": (sort_quality, f"SELECT book_id, (t % 100)::INTEGER AS quality_score FROM (SELECT book_id, sum(w)::BIGINT AS t FROM {_CH} GROUP BY book_id) WHERE t % 100 < 75 ORDER BY 2, 1"),
    "sort_problematic": (sort_problematic, f"SELECT book_id, count(*) AS total_chapters FROM {_CH} GROUP BY book_id HAVING avg(w) < 2000 OR (count(*) > 40 AND avg(w) < 5000) ORDER BY avg(w), book_id"),
    "sink_report_json": (sink_report_json, f"SELECT book_id, '{{\"book_id\":\"' || book_id || '\",\"quality_score\":' || (t % 100) || ',\"total_words\":' || t || '}}' AS json FROM (SELECT book_id, sum(w)::BIGINT AS t FROM {_CH} GROUP BY book_id)"),
}

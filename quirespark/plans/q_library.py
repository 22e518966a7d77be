"""Library analytics: profiles, scores, merges, storage, topic shifts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import library, merging, semantic, storage
from ..sources.tables import document_chapters, order_chapters, read

WORDS = "list_filter(regexp_split_to_array({}, '\\s+'), lambda w: w <> '')"
_N = "row_number() OVER (PARTITION BY source ORDER BY doc_id)"
#: document_chapters, as SQL.
DOCS = f"(SELECT source AS book_id, n AS chapter_number, CASE doc_id % 3 WHEN 0 THEN 'Chapter ' || n || ': Topic ' || doc_id WHEN 1 THEN 'Section ' || n ELSE 'Summary' END AS title, len({WORDS.format('text')})::INTEGER AS word_count, doc_id, text FROM (SELECT *, {_N} AS n FROM documents))"
#: order_chapters, as SQL.
ORDERS = "(SELECT o_custkey AS book_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS chapter_number, floor(o_totalprice / 20)::INTEGER AS word_count, o_orderpriority FROM orders)"

_PROFILE = """SELECT book_id, sum(word_count)::BIGINT AS total_words, count(*) AS total_chapters, avg(word_count) AS avg_words, coalesce(var_samp(word_count), 0.0::DOUBLE) AS variance,
 min(word_count)::BIGINT AS min_words, max(word_count)::BIGINT AS max_words, floor(sum(word_count)::DOUBLE / 0.75::DOUBLE)::BIGINT AS est_tokens,
 count(*) FILTER (word_count < 500) AS n_small, count(*) FILTER (word_count > 20000) AS n_large FROM {} c GROUP BY book_id"""
_COMPLETE = "(CASE WHEN book_id <> 0 THEN 1.5::DOUBLE ELSE 0 END + 1.5::DOUBLE + CASE WHEN author <> '' THEN 1 ELSE 0 END + CASE WHEN total_words <> 0 THEN 1 ELSE 0 END) / 6.0::DOUBLE"
_SCORED = f"""SELECT p.*, m.author, {_COMPLETE} AS completeness FROM ({_PROFILE.format(ORDERS)}) p JOIN (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS author FROM customer) m ON m.c_custkey = p.book_id"""
_SCORE = """floor(round(completeness * 20 + greatest(0.0, 1 - sqrt(variance) / greatest(avg_words, 1.0)) * 30
 + CASE WHEN total_chapters = 1 THEN 5 WHEN total_chapters BETWEEN 3 AND 50 THEN 20 WHEN total_chapters > 50 THEN 15 ELSE 10 END
 + CASE WHEN book_id % 20 = 0 THEN 15 WHEN book_id % 20 < 10 THEN 10 ELSE greatest(0, 15 - book_id % 20) END
 + (1 - (n_small + n_large)::DOUBLE / total_chapters) * 15, 9))::INTEGER"""
_VERDICT = """CASE WHEN total_chapters = 0 THEN 'no_chapters' WHEN avg_words < 2000 THEN 'over-fragmentation' WHEN total_chapters > 40 AND avg_words < 5000 THEN 'suspicious-fragmentation'
 WHEN avg_words > 25000 THEN 'under-fragmentation' WHEN total_chapters < floor(greatest(3, total_words // 10000) / 2) THEN 'too_few_chapters' ELSE 'valid' END"""
_ISSUES = "list_filter([CASE WHEN avg_words < 2000 THEN 'small average' END, CASE WHEN total_chapters > 40 AND avg_words < 5000 THEN 'many small chapters' END, CASE WHEN total_chapters > 3 * greatest(3, total_words // 10000) THEN 'too many chapters' END], lambda x: x IS NOT NULL)"
_MERGE = "SELECT book_id, count(*) >= 3 AND (avg(word_count) < 2000 OR (count(*) > 40 AND avg(word_count) < 5000) OR count(*) FILTER (word_count < 2000)::DOUBLE / count(*) > 0.3::DOUBLE) AS should_merge FROM {} c GROUP BY book_id"


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as books with metadata, joined with the profile of their orders."""
    c = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("book_id"), F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("author"), F.lit("").alias("source_file")
    )
    p = library.profile(order_chapters(spark, sf_dir))
    b = p.join(c, "book_id").withColumn("word_count", F.col("total_words"))
    b = b.withColumn("completeness", library.completeness())
    encoding = (F.col("book_id") % 20).cast("int")
    return b.withColumn("score", library.quality_score(F.col("completeness"), encoding))


def agg_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = library.profile(document_chapters(spark, sf_dir))
    return p.withColumn("variance", F.round("variance", 4)).withColumn("avg_words", F.round("avg_words", 6))


def agg_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _books(spark, sf_dir).select("book_id", F.round("completeness", 6).alias("completeness"))


def agg_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _books(spark, sf_dir).select("book_id", "score", library.bucket(F.col("score")).alias("bucket"))


def agg_validate_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.validate_chunking(library.profile(order_chapters(spark, sf_dir))).select("book_id", "verdict")


def agg_should_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.should_merge(order_chapters(spark, sf_dir))


def agg_book_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.issues(library.profile(document_chapters(spark, sf_dir)))


def agg_quality_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _books(spark, sf_dir).groupBy(library.bucket(F.col("score")).alias("bucket")).agg(F.count("*").alias("books"))


def agg_library_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _books(spark, sf_dir)
    b = b.join(library.issues(b.select("book_id", "total_words", "total_chapters", "avg_words")), "book_id").join(library.should_merge(order_chapters(spark, sf_dir)), "book_id")
    return library.library_report(b)


def agg_compare_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = library.profile(document_chapters(spark, sf_dir))
    return p.agg(F.count("*").alias("books"), F.sum("total_words").alias("total_words"), F.round(F.avg("total_chapters"), 6).alias("avg_chapters"), F.round(F.avg("avg_words"), 6).alias("avg_chapter_words"))


def agg_word_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_chapters(spark, sf_dir).groupBy("book_id").agg(F.sum("word_count").cast("long").alias("words"))


def agg_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both medians: the upper one, and the mean of the middle two of counts above 0."""
    g = order_chapters(spark, sf_dir).groupBy("book_id").agg(F.array_sort(F.collect_list("word_count")).alias("s"), F.expr("percentile(word_count, 0.5) FILTER (WHERE word_count > 0)").alias("median_true"))
    return g.select("book_id", F.element_at("s", (F.floor(F.size("s") / 2) + 1).cast("int")).alias("median_upper"), "median_true")


def validate_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    chapters = document_chapters(spark, sf_dir)
    expected = chapters.groupBy("book_id").agg(F.max("chapter_number").alias("m")).select("book_id", (F.col("m") + F.length("book_id") - 3).alias("expected_chapters"))
    return library.chapter_validation(chapters, expected)


def win_adjacent_merge_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.merge_candidates(document_chapters(spark, sf_dir))


def topk_merge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.top_candidates(merging.merge_candidates(document_chapters(spark, sf_dir))).select("book_id", "chapter_number", "score", "rank")


def merge_small_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.merge_small(order_chapters(spark, sf_dir), 6000, 15000)


def greedy_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.pack(document_chapters(spark, sf_dir), 1000)


def merge_plan_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.merge_plan(order_chapters(spark, sf_dir), 3000)


def auto_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.auto_merge(document_chapters(spark, sf_dir))


def join_books_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("book_id"), F.col("c_name").alias("title"))
    o = order_chapters(spark, sf_dir).filter("o_orderpriority = '1-URGENT'")
    g = c.join(o, "book_id", "left").groupBy("book_id", "title").agg(F.count("word_count").alias("chapters"), F.coalesce(F.sum("word_count"), F.lit(0)).cast("long").alias("words"), F.round(F.coalesce(F.avg("word_count"), F.lit(0.0)), 6).alias("avg_words"))
    return g.filter("chapters > 0")


def mig_backfill_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("book_id"), F.when(F.col("c_custkey") % 2 == 0, 0).otherwise(F.col("c_custkey")).cast("long").alias("word_count"))
    return storage.backfill_word_counts(c, order_chapters(spark, sf_dir).filter("o_orderpriority = '2-HIGH'"))


def join_files_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.concat("doc_id", F.lit(".epub")).alias("name"))
    done = read(spark, sf_dir, "labels").select(F.concat("doc_id", F.lit(".epub")).alias("name"))
    todo, skipped = storage.split_processed(docs, done)
    return todo.withColumn("state", F.lit("todo")).unionByName(skipped.withColumn("state", F.lit("skipped")))


def sink_checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return storage.latest_state(e, "user_id", ["ts", "event_id"], ["value"], ["event_type", "event_id"])


def incomplete_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sink_checkpoint_upsert(spark, sf_dir).filter("event_type <> 'purchase'").select("user_id", "event_type")


def sink_upsert_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    new = c.filter("id % 3 = 0").withColumn("title", F.concat("title", F.lit("*"))).unionByName(c.filter("id % 50 = 1").select((F.col("id") + 1000000).alias("id"), "title"))
    return storage.upsert(c, new, "id")


def agg_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = library.profile(order_chapters(spark, sf_dir))
    return storage.batch_summary(p.select((F.col("book_id") % 7 != 0).alias("success"), F.col("total_chapters").alias("chapters_count"), F.col("total_words").alias("word_count")))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("label").alias("book_id"), F.col("vec_id").alias("position"), "embedding")


def win_adjacent_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.similarities(_vectors(spark, sf_dir)).withColumn("similarity", F.round("similarity", 6))


def detect_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.boundaries(_vectors(spark, sf_dir)).select("book_id", "position", "is_significant")


def join_nearest_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    chapters = d.select(F.col("source").alias("book_id"), (F.col("doc_id") * 7).alias("line_index"))
    bounds = d.select(F.col("source").alias("book_id"), (F.col("doc_id") * 5 + 2).alias("line_index"))
    return semantic.nearest_boundary(chapters, bounds)


def heuristic_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir)
    return c.select("doc_id", semantic.heuristic_confidence(F.col("word_count") * 10, F.col("title")).alias("confidence"))


def reingest_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old against new chapters of a book: urgent orders against all."""
    o = order_chapters(spark, sf_dir)
    old = o.filter("o_orderpriority = '1-URGENT'").groupBy("book_id").agg(F.count("*").alias("old_n"), F.sum("word_count").cast("long").alias("old_words"))
    new = o.groupBy("book_id").agg(F.count("*").alias("new_n"), F.sum("word_count").cast("long").alias("new_words"))
    j = old.join(new, "book_id", "right").fillna(0, ["old_n", "old_words"])
    verdict = F.when((F.col("old_words") == 0) & (F.col("new_words") > 0), "recovered").when(F.col("new_words") < F.col("old_words") * 0.9, "lost").when(F.col("new_n") > F.col("old_n"), "split").otherwise("same")
    return j.withColumn("verdict", verdict)


def win_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir)
    big = F.count_if(F.col("word_count") >= 200).over(Window.partitionBy("book_id"))
    kept = c.withColumn("big", big).filter((F.col("word_count") >= 200) | (F.col("big") < 2))
    n = F.row_number().over(Window.partitionBy("book_id").orderBy("chapter_number"))
    return kept.select("doc_id", F.concat("book_id", F.lit("-ch"), n).alias("id"), n.alias("chapter_number"))


def fn_json_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = document_chapters(spark, sf_dir).select("doc_id", F.to_json(F.struct("chapter_number", "word_count")).alias("json"))
    back = F.from_json("json", "chapter_number int, word_count int")
    return c.select("doc_id", back["chapter_number"].alias("chapter_number"), back["word_count"].alias("word_count"))


_GREEDY = """WITH RECURSIVE c AS (SELECT book_id, chapter_number, word_count::BIGINT AS w FROM {src} c), f AS (
 SELECT book_id, 1 AS n, 1 AS pack, 1 AS first, w AS words FROM c WHERE chapter_number = 1
 UNION ALL SELECT c.book_id, c.chapter_number, f.pack + CASE WHEN {take} THEN 0 ELSE 1 END, CASE WHEN {take} THEN f.first ELSE c.chapter_number END, CASE WHEN {take} THEN f.words + c.w ELSE c.w END
 FROM f JOIN c ON c.book_id = f.book_id AND c.chapter_number = f.n + 1)
"""
_CAND = f"""WITH a AS (SELECT book_id, chapter_number, title, word_count, lead(word_count) OVER w AS nw, lead(title) OVER w AS nt FROM {DOCS} c WINDOW w AS (PARTITION BY book_id ORDER BY chapter_number)),
 b AS (SELECT *, word_count + nw AS combined, nullif(regexp_extract(title, '(?i)^chapter\\s+(\\d+)', 1), '')::INTEGER AS x, nullif(regexp_extract(nt, '(?i)^chapter\\s+(\\d+)', 1), '')::INTEGER AS y FROM a WHERE nw IS NOT NULL AND word_count + nw <= 25000),
 r AS (SELECT *, word_count < 2000 AS r1, nw < 2000 AS r2, regexp_matches(nt, '(?i)^Section\\s+\\d+$|^Summary\\s*$') AS r3, coalesce(x > 0 AND y > 0 AND y <> x + 1, false) AS r4, combined BETWEEN 3000 AND 15000 AS r5 FROM b),
 s AS (SELECT book_id, chapter_number, combined, round(least(1.0::DOUBLE, 0.0::DOUBLE + CASE WHEN r1 THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN r2 THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN r3 THEN 0.25::DOUBLE ELSE 0 END + CASE WHEN r4 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN r5 THEN 0.1::DOUBLE ELSE 0 END), 6) AS score,
 array_to_string(list_filter([CASE WHEN r1 THEN 'small' END, CASE WHEN r2 THEN 'next small' END, CASE WHEN r3 THEN 'subsection' END, CASE WHEN r4 THEN 'gap' END, CASE WHEN r5 THEN 'good size' END], lambda z: z IS NOT NULL), ';') AS reasons FROM r)
"""
_LATEST = "SELECT user_id, arg_min(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS event_type, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id"
_COS = "SELECT label AS book_id, vec_id AS position, list_cosine_similarity(embedding::DOUBLE[], (lead(embedding) OVER (PARTITION BY label ORDER BY vec_id))::DOUBLE[]) AS c, lead(vec_id) OVER (PARTITION BY label ORDER BY vec_id) AS nx FROM embeddings"

CATALOG = {
    "agg_profile": (agg_profile, f"SELECT * REPLACE (round(variance, 4) AS variance, round(avg_words, 6) AS avg_words) FROM ({_PROFILE.format(DOCS)})"),
    "agg_completeness": (agg_completeness, f"SELECT book_id, round(completeness, 6) AS completeness FROM ({_SCORED})"),
    "agg_quality_score": (agg_quality_score, f"SELECT book_id, score, CASE WHEN score >= 75 THEN 'good' WHEN score >= 50 THEN 'fair' ELSE 'poor' END AS bucket FROM (SELECT book_id, {_SCORE} AS score FROM ({_SCORED}))"),
    "agg_validate_chunking": (agg_validate_chunking, f"SELECT book_id, {_VERDICT} AS verdict FROM ({_PROFILE.format(ORDERS)})"),
    "agg_should_merge": (agg_should_merge, _MERGE.format(ORDERS)),
    "agg_book_issues": (agg_book_issues, f"SELECT book_id, len({_ISSUES})::INTEGER AS n_issues, array_to_string({_ISSUES}, ';') AS issues FROM ({_PROFILE.format(DOCS)})"),
    "agg_quality_buckets": (agg_quality_buckets, f"SELECT CASE WHEN score >= 75 THEN 'good' WHEN score >= 50 THEN 'fair' ELSE 'poor' END AS bucket, count(*) AS books FROM (SELECT {_SCORE} AS score FROM ({_SCORED})) GROUP BY 1"),
    "agg_library_report": (
        agg_library_report,
        f"SELECT count(*) AS books, count(*) FILTER (score >= 75) AS good, count(*) FILTER (score BETWEEN 50 AND 74) AS fair, count(*) FILTER (score < 50) AS poor, count(*) FILTER (should_merge) AS needs_merge, count(*) FILTER (len({_ISSUES}) > 0) AS has_issues, round(avg(score), 6) AS avg_score FROM (SELECT *, {_SCORE} AS score FROM ({_SCORED})) b JOIN ({_MERGE.format(ORDERS)}) m ON m.book_id = b.book_id",
    ),
    "agg_compare_profiles": (agg_compare_profiles, f"SELECT count(*) AS books, sum(total_words)::BIGINT AS total_words, round(avg(total_chapters), 6) AS avg_chapters, round(avg(avg_words), 6) AS avg_chapter_words FROM ({_PROFILE.format(DOCS)})"),
    "agg_word_rollup": (agg_word_rollup, f"SELECT book_id, sum(word_count)::BIGINT AS words FROM {DOCS} c GROUP BY book_id"),
    "agg_medians": (agg_medians, f"SELECT book_id, list_sort(list(word_count))[count(*) // 2 + 1] AS median_upper, quantile_cont(word_count::DOUBLE, 0.5) FILTER (word_count > 0) AS median_true FROM {ORDERS} c GROUP BY book_id"),
    "validate_chapters": (
        validate_chapters,
        f"WITH g AS (SELECT book_id, count(*) AS n, sum(word_count) AS words, list_sort(list(word_count))[count(*) // 2 + 1] AS median, max(word_count) AS largest, count(*) FILTER (word_count < 100) AS tiny, count(*) FILTER (word_count > 30000) AS huge, count(*) FILTER (regexp_matches(title, '^Section\\s+\\d+$')) AS generic, max(chapter_number) + length(book_id) - 3 AS expected FROM {DOCS} c GROUP BY book_id), e AS (SELECT *, expected - n AS missing, (CASE WHEN expected - n > 3 THEN 1 ELSE 0 END + CASE WHEN generic > 0 AND generic = n THEN 1 ELSE 0 END)::BIGINT AS n_errors FROM g) SELECT book_id, n, median::BIGINT AS median_words, n_errors, (CASE WHEN missing BETWEEN 1 AND 3 THEN 1 ELSE 0 END + CASE WHEN words > 50000 AND n < greatest(3, words // 20000) THEN 1 ELSE 0 END + huge + CASE WHEN tiny > 0 THEN 1 ELSE 0 END + CASE WHEN n >= 3 AND median > 0 AND largest > 5 * median THEN 1 ELSE 0 END)::BIGINT AS n_warnings, n_errors = 0 AS is_valid FROM e",
    ),
    "win_adjacent_merge_score": (win_adjacent_merge_score, _CAND + "SELECT book_id, chapter_number, combined, score, reasons FROM s WHERE reasons <> ''"),
    "topk_merge_candidates": (topk_merge_candidates, _CAND + "SELECT book_id, chapter_number, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY score DESC, chapter_number) AS rank FROM s WHERE reasons <> '') WHERE rank <= 5"),
    "merge_small_pipeline": (
        merge_small_pipeline,
        _GREEDY.format(src=ORDERS, take="(f.words < 6000 AND f.words + c.w <= 15000)")
        + ", m AS (SELECT book_id, pack AS chapter_number, min(first) AS first_chapter, max(n) AS last_chapter, max(words) AS word_count FROM f GROUP BY book_id, pack), t AS (SELECT book_id, count(*) AS n, greatest(2, floor(sum(w) / 15000)) AS least FROM c GROUP BY book_id), k AS (SELECT t.*, (SELECT count(*) FROM m WHERE m.book_id = t.book_id) AS after FROM t) SELECT m.* FROM m JOIN k ON k.book_id = m.book_id WHERE NOT (k.after < k.least AND k.least <= k.n) UNION ALL SELECT c.book_id, c.chapter_number, c.chapter_number, c.chapter_number, c.w FROM c JOIN k ON k.book_id = c.book_id WHERE k.after < k.least AND k.least <= k.n",
    ),
    "greedy_pack": (greedy_pack, _GREEDY.format(src=DOCS, take="(f.words + c.w <= 1000)") + "SELECT book_id, pack, min(first)::INTEGER AS first_chapter, max(n)::INTEGER AS last_chapter, max(words) AS word_count FROM f GROUP BY book_id, pack"),
    "merge_plan_analysis": (
        merge_plan_analysis,
        f"WITH RECURSIVE c AS (SELECT book_id, chapter_number::INTEGER AS n, word_count AS w FROM {ORDERS} c), f AS (SELECT book_id, n, false AS gone, w < 3000 AS takes FROM c WHERE n = 1 UNION ALL SELECT c.book_id, c.n, f.takes OR (c.w < 3000 AND NOT f.gone), c.w < 3000 AND NOT (f.takes OR (c.w < 3000 AND NOT f.gone)) FROM f JOIN c ON c.book_id = f.book_id AND c.n = f.n + 1) SELECT book_id, n AS chapter_number, n - 1 AS into_chapter FROM f WHERE gone",
    ),
    "auto_merge": (auto_merge, ""),
    "join_books_chapters": (join_books_chapters, f"SELECT c_custkey AS book_id, c_name AS title, count(word_count) AS chapters, coalesce(sum(word_count), 0)::BIGINT AS words, round(coalesce(avg(word_count), 0), 6) AS avg_words FROM customer LEFT JOIN (SELECT * FROM {ORDERS} c WHERE o_orderpriority = '1-URGENT') o ON o.book_id = c_custkey GROUP BY 1, 2 HAVING count(word_count) > 0"),
    "mig_backfill_word_counts": (mig_backfill_word_counts, f"WITH o AS (SELECT * FROM {ORDERS} c WHERE o_orderpriority = '2-HIGH'), b AS (SELECT c_custkey AS book_id, CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE c_custkey END AS w FROM customer) SELECT book_id, CASE WHEN w = 0 AND EXISTS (SELECT 1 FROM o WHERE o.book_id = b.book_id) THEN (SELECT sum(word_count) FROM o WHERE o.book_id = b.book_id) ELSE w END::BIGINT AS word_count FROM b"),
    "join_files_processed": (join_files_processed, "SELECT doc_id || '.epub' AS name, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'skipped' ELSE 'todo' END AS state FROM documents"),
    "sink_checkpoint_upsert": (sink_checkpoint_upsert, _LATEST),
    "incomplete_jobs": (incomplete_jobs, f"SELECT user_id, event_type FROM ({_LATEST}) WHERE event_type <> 'purchase'"),
    "sink_upsert_books": (sink_upsert_books, "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name || '*' ELSE c_name END AS title FROM customer UNION ALL SELECT c_custkey + 1000000, c_name FROM customer WHERE c_custkey % 50 = 1"),
    "agg_batch_summary": (agg_batch_summary, f"SELECT count(*) AS total, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, sum(total_chapters) FILTER (ok)::BIGINT AS chapters, sum(total_words) FILTER (ok)::BIGINT AS words, count(*) FILTER (ok)::DOUBLE / count(*) AS success_rate FROM (SELECT *, book_id % 7 <> 0 AS ok FROM ({_PROFILE.format(ORDERS)}))"),
    "win_adjacent_similarity": (win_adjacent_similarity, f"SELECT book_id, position, round(c, 6) AS similarity FROM ({_COS}) WHERE nx IS NOT NULL"),
    "detect_boundaries": (detect_boundaries, f"SELECT book_id, position, c < quantile_cont(c, 0.1) OVER (PARTITION BY book_id) AS is_significant FROM ({_COS}) WHERE nx IS NOT NULL"),
    "join_nearest_boundary": (
        join_nearest_boundary,
        "WITH c AS (SELECT source AS book_id, doc_id * 7 AS line_index FROM documents), b AS (SELECT source AS book_id, doc_id * 5 + 2 AS bl FROM documents) SELECT c.book_id, c.line_index, arg_min(bl, (abs(c.line_index - bl), bl)) AS boundary_line, min(abs(c.line_index - bl)) AS distance FROM c LEFT JOIN b ON b.book_id = c.book_id GROUP BY 1, 2",
    ),
    "heuristic_confidence": (
        heuristic_confidence,
        f"SELECT doc_id, round(greatest(0.0, least(1.0, 0.5::DOUBLE + CASE WHEN w BETWEEN 2000 AND 20000 THEN 0.2::DOUBLE WHEN w < 1000 THEN -0.2::DOUBLE WHEN w > 25000 THEN -0.1::DOUBLE ELSE 0 END + CASE WHEN regexp_matches(title, '(?i)^(Chapter|Part|Lesson|Module|Unit)\\s+\\d+') THEN 0.2::DOUBLE WHEN regexp_matches(title, '^Section\\s+\\d+$') THEN -0.3::DOUBLE ELSE 0 END)), 6) AS confidence FROM (SELECT *, word_count * 10 AS w FROM {DOCS} c)",
    ),
    "reingest_compare": (
        reingest_compare,
        f"SELECT *, CASE WHEN old_words = 0 AND new_words > 0 THEN 'recovered' WHEN new_words < old_words * 0.9 THEN 'lost' WHEN new_n > old_n THEN 'split' ELSE 'same' END AS verdict FROM (SELECT book_id, count(*) FILTER (o_orderpriority = '1-URGENT') AS old_n, coalesce(sum(word_count) FILTER (o_orderpriority = '1-URGENT'), 0)::BIGINT AS old_words, count(*) AS new_n, sum(word_count)::BIGINT AS new_words FROM {ORDERS} c GROUP BY book_id)",
    ),
    "win_renumber": (
        win_renumber,
        f"SELECT doc_id, book_id || '-ch' || n AS id, n::INTEGER AS chapter_number FROM (SELECT doc_id, book_id, row_number() OVER (PARTITION BY book_id ORDER BY chapter_number) AS n FROM (SELECT *, count(*) FILTER (word_count >= 200) OVER (PARTITION BY book_id) AS big FROM {DOCS} c) WHERE word_count >= 200 OR big < 2)",
    ),
    "fn_json_chapters": (fn_json_chapters, f"SELECT doc_id, chapter_number::INTEGER AS chapter_number, word_count FROM {DOCS} c"),
}

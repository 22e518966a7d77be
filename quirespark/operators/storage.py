"""Tables of books, chapters and jobs: lookups, upserts, states, rendering and folders.

Tables are immutable: each sink returns the table as it is after the change,
to be written over the old one or merged into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escape_yaml, sanitize_filename, strip


def latest_state(log: DataFrame, key: str, order: list[str], first: list[str], last: list[str]) -> DataFrame:
    """One row for each key: some columns of its first row, others of its last."""
    at = F.struct(*order)
    return log.groupBy(key).agg(*[F.min_by(c, at).alias(c) for c in first], *[F.max_by(c, at).alias(c) for c in last])


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``old`` whose key isn't in ``new``, and all of ``new``."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def backfill_word_counts(books: DataFrame, chapters: DataFrame) -> DataFrame:
    """Books with a count of 0 take the sum of their chapters, where they have any."""
    sums = chapters.groupBy("book_id").agg(F.sum("word_count").alias("__sum"))
    joined = books.join(sums, "book_id", "left")
    count = F.when((F.col("word_count") == 0) & F.col("__sum").isNotNull(), F.col("__sum")).otherwise(F.col("word_count"))
    return joined.withColumn("word_count", count.cast("long")).drop("__sum")


def split_processed(files: DataFrame, done: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(to do, skipped): files whose name is not, or is, among the processed ones."""
    names = done.select(name).distinct()
    return files.join(names, name, "left_anti"), files.join(names, name, "left_semi")


#: What a book has that nothing is known of; fixed values.
BOOK_DEFAULTS = {"title": "Unknown", "word_count": 0, "processing_status": "processing"}
COMPLETED = "completed"


def insert_books(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` with the rows of ``new`` added or put in place of those of their ids; gaps take BOOK_DEFAULTS."""
    for c, value in BOOK_DEFAULTS.items():
        new = new.withColumn(c, F.coalesce(c, F.lit(value)) if c in new.columns else F.lit(value))
    return upsert(old, new, "id")


def update_status(books: DataFrame, changes: DataFrame) -> DataFrame:
    """``changes`` has (id, processing_status)."""
    new = changes.select("id", F.col("processing_status").alias("__new"))
    return books.join(new, "id", "left").withColumn("processing_status", F.coalesce("__new", "processing_status")).drop("__new")


def delete_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key).distinct(), key, "left_anti")


def newest_books(books: DataFrame) -> DataFrame:
    return books.orderBy(F.col("added_date").desc(), "id")


def book(books: DataFrame, id_: str | int) -> DataFrame:
    return books.filter(F.col("id") == F.lit(id_))


def chapters_of(chapters: DataFrame, book_id: str | int) -> DataFrame:
    return chapters.filter(F.col("book_id") == F.lit(book_id)).orderBy("chapter_number")


def checkpoint_of(jobs: DataFrame, source_hash: str) -> DataFrame:
    return jobs.filter(F.col("source_hash") == source_hash)


def incomplete(jobs: DataFrame) -> DataFrame:
    """Jobs that have not come to the end, the latest first."""
    return jobs.filter(F.col("stage") != COMPLETED).orderBy(F.col("updated_at").desc(), "source_hash")


def processed_filenames(books: DataFrame) -> DataFrame:
    """(name): distinct file names of the completed books."""
    name = F.regexp_extract("source_file", r"[^/]+$", 0)
    return books.filter((F.col("processing_status") == COMPLETED) & (name != "")).select(name.alias("name")).distinct()


def unembedded(chapters: DataFrame, force: bool = False) -> DataFrame:
    return (chapters if force else chapters.filter("embedding IS NULL")).orderBy("id")


def update_embeddings(chapters: DataFrame, vectors: DataFrame) -> DataFrame:
    """``vectors`` has (id, embedding, embedding_model); other chapters keep theirs."""
    new = vectors.select("id", F.col("embedding").alias("__e"), F.col("embedding_model").alias("__m"))
    j = chapters.join(new, "id", "left")
    return j.withColumn("embedding", F.coalesce("__e", "embedding")).withColumn("embedding_model", F.coalesce("__m", "embedding_model")).drop("__e", "__m")


def replace_chapters(books: DataFrame, chapters: DataFrame, new: DataFrame, status: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(books, chapters) after the chapters of the books in ``new`` are replaced by it; their word counts follow."""
    kept = delete_keys(chapters, new, "book_id").unionByName(new, allowMissingColumns=True)
    sums = new.groupBy(F.col("book_id").alias("id")).agg(F.sum("word_count").cast("long").alias("__words"))
    b = books.join(sums, "id", "left").withColumn("word_count", F.coalesce("__words", F.col("word_count").cast("long")))
    if status is not None:
        b = b.withColumn("processing_status", F.when(F.col("__words").isNotNull(), F.lit(status)).otherwise(F.col("processing_status")))
    return b.drop("__words"), kept


def apply_merges(books: DataFrame, chapters: DataFrame, merged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(books, chapters, backup): ``replace_chapters`` with the status "reprocessed", and the rows replaced."""
    backup = chapters.join(merged.select("book_id").distinct(), "book_id", "left_semi")
    b, c = replace_chapters(books, chapters, merged, "reprocessed")
    return b, c, backup


def render_section(
    title: Column, number: Column, tokens: Column, n_words: Column, body: Column, section: Column | None = None, total: Column | None = None, parent: Column | None = None, partial: Column | None = None
) -> Column:
    """A Markdown file: front matter, heading, a line of sizes, body.

    A part of a chapter has its ``section`` number, the ``total`` and the ``parent``'s title.
    """
    n, more = F.lit("\n"), F.lit("")
    if section is not None:
        more = F.concat(F.lit("\nsection: "), section, F.lit("\ntotal_sections: "), total, F.lit('\nparent_chapter: "'), escape_yaml(parent), F.lit('"'))
    if partial is not None:
        more = F.concat(more, F.when(partial, F.lit("\nis_partial: true")).otherwise(""))
    head = F.concat(F.lit('---\ntitle: "'), escape_yaml(title), F.lit('"\nchapter: '), number, F.lit("\ntokens: "), tokens, F.lit("\nwords: "), n_words, more, F.lit("\n---"))
    place = F.concat(F.lit("**Chapter "), number, F.lit("**") if section is None else F.concat(F.lit(", Section "), section, F.lit("/"), total, F.lit("**")))
    sizes = F.concat(F.lit(" | *"), F.format_string("%,d", n_words), F.lit(" words* | *~"), F.format_string("%,d", tokens.cast("long")), F.lit(" tokens*"))
    return F.concat(head, F.lit("\n\n# "), title, n, n, place, sizes, F.lit("\n\n---\n\n"), body)


def render_chapter(title: Column, number: Column, n_words: Column, body: Column) -> Column:
    """A chapter of a book without sections as a Markdown file."""
    return F.concat(F.lit("# "), title, F.lit("\n\n**Chapter "), number, F.lit("**\n*Word Count: "), n_words, F.lit("*\n\n---\n\n"), F.coalesce(body, F.lit("")))


def render_index(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, body) of the index of every chapter of ``sections`` that has several.

    ``sections`` has (keys, parent_title, chapter_number, section_number, title, token_count, word_count).
    """
    name = sanitize_filename(F.concat(F.lpad(F.col("section_number").cast("string"), 2, "0"), F.lit("-"), "title", F.lit(".md")))
    line = F.concat(F.col("section_number").cast("string"), F.lit(". ["), "title", F.lit("](./"), name, F.lit(") (~"), F.format_string("%,d", F.col("token_count").cast("long")), F.lit(" tokens)"))
    g = sections.groupBy(*keys).agg(
        F.first("parent_title").alias("t"),
        F.first("chapter_number").alias("c"),
        F.count("*").alias("n"),
        F.sum("token_count").cast("long").alias("tokens"),
        F.sum("word_count").cast("long").alias("words"),
        F.array_sort(F.collect_list(F.struct("section_number", line.alias("line")))).alias("l"),
    )
    head = F.concat(F.lit('---\ntitle: "'), escape_yaml(F.col("t")), F.lit('"\nchapter: '), "c", F.lit("\ntotal_sections: "), "n", F.lit("\ntotal_tokens: "), "tokens", F.lit("\ntotal_words: "), "words", F.lit("\n---\n\n# "), "t")
    text = F.concat(F.lit("\n\n**Chapter "), "c", F.lit("** | *"), "n", F.lit(" sections* | *"), F.format_string("%,d", F.col("words")), F.lit(" words total*\n\nThis chapter has been split into multiple sections for AI readability.\n\n## Sections\n\n"))
    return g.filter("n > 1").select(*keys, F.concat(head, text, F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("body"))


def section_counts(sections: DataFrame) -> DataFrame:
    """(book_id, section_count, split_chapters): chapters of several sections are split."""
    c = sections.groupBy("book_id", "chapter_number").agg(F.count("*").alias("n"))
    return c.groupBy("book_id").agg(F.sum("n").alias("section_count"), F.count_if(F.col("n") > 1).alias("split_chapters"))


def section_files(sections: DataFrame) -> DataFrame:
    """(book_id, path, body) of a library's sections: a file for a whole chapter, a folder with an index for a split one."""
    keys = ["book_id", "chapter_number"]
    t = sections.withColumn("total", F.count("*").over(Window.partitionBy(*keys)))
    folder = F.concat(F.lpad(F.col("chapter_number").cast("string"), 2, "0"), F.lit("-"), "parent_title")
    one = sanitize_filename(F.concat(folder, F.lit(".md")))
    part = sanitize_filename(F.concat(F.lpad(F.col("section_number").cast("string"), 2, "0"), F.lit("-"), "title", F.lit(".md")))
    sizes = [F.col("token_count"), F.col("word_count"), F.col("content")]
    whole = render_section(F.col("parent_title"), F.col("chapter_number"), *sizes, partial=F.col("is_partial"))
    some = render_section(F.col("title"), F.col("chapter_number"), *sizes, F.col("section_number"), F.col("total"), F.col("parent_title"), F.col("is_partial"))
    single = F.col("total") == 1
    files = t.select("book_id", F.when(single, one).otherwise(F.concat_ws("/", sanitize_filename(folder), part)).alias("path"), F.when(single, whole).otherwise(some).alias("body"))
    names = sections.groupBy(*keys).agg(F.first("parent_title").alias("parent_title"))
    index = render_index(sections, keys).join(names, keys).select("book_id", F.concat(sanitize_filename(folder), F.lit("/_index.md")).alias("path"), "body")
    return files.unionByName(index)


def chapter_files(chapters: DataFrame) -> DataFrame:
    """(book_id, path, body, content_hash) of chapters without sections."""
    name = sanitize_filename(F.concat(F.lpad(F.col("chapter_number").cast("string"), 2, "0"), F.lit("-"), "title", F.lit(".md")))
    t = chapters.withColumn("body", render_chapter(F.col("title"), F.col("chapter_number"), F.col("word_count"), F.col("content")))
    return t.select("book_id", name.alias("path"), "body", F.sha2("body", 256).alias("content_hash"))


def repaired_files(chapters: DataFrame) -> DataFrame:
    """(book_id, path, body): files as a repair writes them, with a short slug of letters, digits and blanks."""
    slug = F.regexp_replace(strip(F.substring(F.regexp_replace(F.lower("title"), r"(?U)[^\w\s]|_", ""), 1, 50)), r"(?U)\s+", "-")
    name = F.concat(F.lpad(F.col("chapter_number").cast("string"), 2, "0"), F.lit("-"), slug, F.lit(".md"))
    head = F.concat(F.lit('---\ntitle: "'), escape_yaml(F.col("title")), F.lit('"\nchapter: '), "chapter_number", F.lit("\nword_count: "), "word_count", F.lit("\n---\n\n"))
    return chapters.select("book_id", name.alias("path"), F.concat(head, "content").alias("body"))


def write_files(files: DataFrame, folder: str) -> None:
    """Write (book_id, path, body) as Parquet by book, the form in which a cluster stores many small files."""
    files.write.partitionBy("book_id").mode("overwrite").parquet(folder)


def book_metadata(books: DataFrame, chapters: DataFrame, sections: DataFrame | None = None) -> DataFrame:
    """(id, metadata): the JSON that stands beside a book's files."""
    n = chapters.groupBy(F.col("book_id").alias("id")).agg(F.count("*").alias("chapter_count"))
    b = books.join(n, "id", "left").withColumn("chapter_count", F.coalesce("chapter_count", F.lit(0)))
    fields = ["id", F.coalesce("title", F.lit("Unknown")).alias("title"), "author", F.coalesce("word_count", F.lit(0)).alias("word_count"), "chapter_count"]
    if sections is not None:
        b = b.join(section_counts(sections).withColumnRenamed("book_id", "id"), "id", "left")
        fields += [F.coalesce("section_count", F.lit(0)).alias("section_count"), F.coalesce("split_chapters", F.lit(0)).alias("split_chapters"), F.lit(15000).alias("max_tokens_per_file")]
    return b.select("id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("metadata"))


def file_name(number: Column, title: Column) -> Column:
    return F.concat(F.lpad(number.cast("string"), 2, "0"), F.lit("-"), sanitize_filename(title), F.lit(".md"))


def batch_summary(results: DataFrame) -> DataFrame:
    """One row over results of files (success, chapters_count, word_count)."""
    ok = F.col("success")
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("chapters_count"))), F.lit(0)).cast("long").alias("chapters"),
        F.coalesce(F.sum(F.when(ok, F.col("word_count"))), F.lit(0)).cast("long").alias("words"),
        F.coalesce(F.try_divide(F.count_if(ok).cast("double"), F.count("*")), F.lit(0.0)).alias("success_rate"),
    )

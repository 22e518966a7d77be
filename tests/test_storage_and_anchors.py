"""Rendered files, sentence buffers, anchors in the text and block windows."""

import json
import random
import re

from pyspark.sql import functions as F

from quirespark.functions import lines as ln
from quirespark.functions import text as t
from quirespark.operators import anchors, metadata, semantic, storage


def test_section_files(spark):
    rows = [(1, 1, "One", 1, "One", 10, 7, "a", False), (1, 2, 'Two "x"', 1, "First", 1500, 1100, "b", False), (1, 2, 'Two "x"', 2, "Second (Part 1)", 5, 3, "c", True)]
    df = spark.createDataFrame(rows, "book_id int, chapter_number int, parent_title string, section_number int, title string, token_count long, word_count int, content string, is_partial boolean")
    files = {r.path: r.body for r in storage.section_files(df).collect()}
    assert files["01-one.md"] == '---\ntitle: "One"\nchapter: 1\ntokens: 10\nwords: 7\n---\n\n# One\n\n**Chapter 1** | *7 words* | *~10 tokens*\n\n---\n\na'
    assert files["02-two-x/01-first.md"] == (
        '---\ntitle: "First"\nchapter: 2\ntokens: 1500\nwords: 1100\nsection: 1\ntotal_sections: 2\nparent_chapter: "Two \\"x\\""\n---\n\n# First\n\n**Chapter 2, Section 1/2** | *1,100 words* | *~1,500 tokens*\n\n---\n\nb'
    )
    assert "is_partial: true" in files["02-two-x/02-second-part-1.md"]
    assert files["02-two-x/_index.md"].endswith("## Sections\n\n1. [First](./01-first.md) (~1,500 tokens)\n2. [Second (Part 1)](./02-second-part-1.md) (~5 tokens)")
    assert len(files) == 4
    books = spark.createDataFrame([(1, None, 11)], "id int, title string, word_count int").withColumn("author", F.lit(None).cast("string"))
    chapters = spark.createDataFrame([(1, 1), (1, 2)], "book_id int, chapter_number int")
    got = json.loads(storage.book_metadata(books, chapters, df).first().metadata)
    assert got == {"id": 1, "title": "Unknown", "author": None, "word_count": 11, "chapter_count": 2, "section_count": 3, "split_chapters": 1, "max_tokens_per_file": 15000}


def test_repaired_files_and_folder(spark, tmp_path):
    c = spark.createDataFrame([(1, 3, "A Very: Long_Title " * 5, 4, "body")], "book_id int, chapter_number int, title string, word_count int, content string")
    f = storage.repaired_files(c)
    r = f.first()
    assert r.path.startswith("03-a-very-longtitle-a-very") and len(r.path) <= 56 and r.body.endswith("---\n\nbody")
    storage.write_files(f, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).first().body == r.body


def test_sentence_buffers(spark):
    rng = random.Random(1)
    line = lambda: " ".join(" ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(2, 12))) + rng.choice(".!?") for _ in range(rng.randint(0, 4)))
    text = "\n".join(rng.choice(["", "  "]) + line() for _ in range(40))
    want, at = [], 0
    for i, x in enumerate(text.split("\n")):
        for s in re.split(r"(?<=[.!?])\s+", x.strip()):
            if len(s.split()) >= 5:
                if want and len(want[-1][0].split()) < 30:
                    want[-1] = (want[-1][0] + " " + s, i, want[-1][2])
                else:
                    want.append((s, i, at))
        at += len(x) + 1
    got = semantic.sentence_buffers(spark.createDataFrame([(1, text), (2, ""), (3, None)], "book_id int, text string"), 30).orderBy("position").collect()
    assert [(r.text, r.line_index, r.start_pos) for r in got] == want


def test_anchors_are_found_near_their_hints(spark):
    text = "Intro\nThe Road\nx\nThe Road\ny\nThe Road (end)\nz"
    rows = [(1, "a", "The Road", 0, None), (1, "b", "The Road", 18, None), (1, "c", "The Road", 40, None), (1, "d", "nowhere", 5, 6), (1, "e", "nowhere", 5, 60), (1, "f", "", 5, 2), (1, "g", "The Road (end)\nz" + "?" * 40, 3, None), (1, "h", "x\nThe Road\ny\nThe Road (end)\nz?", 0, None)]
    a = spark.createDataFrame(rows, "book_id int, k string, fingerprint string, hint int, stored_line int")
    got = {r.k: r.line_index for r in anchors.resolve_lines(a, spark.createDataFrame([(1, text)], "book_id int, text string")).collect()}
    assert got == {"a": 1, "b": 3, "c": 5, "d": 6, "f": 2}
    ok = spark.createDataFrame([("abcdef", "cde", 2), ("abcdef", "cde", 1), ("abc", "", 0)], "t string, f string, o int").select(anchors.fingerprint_valid(F.col("t"), F.col("f"), F.col("o")).alias("v")).collect()
    assert [r.v for r in ok] == [True, False, False]


def test_windows_in_blocks_equal_those_over_books(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(1, i, rng.choice(["", "$ run it", "def f(x):", "1. Numbered Heading", "CHAPTER 3", "A Title Of Words", "plain words that go on and on for a while here", "2. Other Thing Here"])) for i in range(900)]
    df = spark.createDataFrame(rows, "book_id int, line_index int, line string")
    whole = {f.__name__: sorted(map(repr, f(df).collect())) for f in (ln.in_code, ln.context, ln.candidates)}
    monkeypatch.setattr(ln, "BLOCK", 128)
    assert {f.__name__: sorted(map(repr, f(df).collect())) for f in (ln.in_code, ln.context, ln.candidates)} == whole


def test_recommendations_of_checked_chapters(spark):
    c = spark.createDataFrame([(1, 1, "A", 900, 0), (1, 2, "B", 800, 500), (1, 3, "C", 5000, 1000)], "book_id int, chapter_number int, title string, word_count int, line_index int")
    b = spark.createDataFrame([(1, 1010, 0.2)], "book_id int, line_index int, similarity double")
    v = semantic.validate(c, b)
    rows = {r.chapter_number: r for r in v.collect()}
    assert [rows[i].merge_with_previous for i in (1, 2, 3)] == [False, True, False]
    assert rows[3].is_valid and abs(rows[3].confidence - (0.5 + 0.5 * 0.8 * 0.8)) < 1e-9
    assert semantic.recommendations(v).first().recommendations == ["Merge with the previous chapter: 2", "Under half of the chapters start at a topic shift"]


def test_metadata_prefers_what_the_file_says(spark):
    df = spark.createDataFrame([("/x/name (1).pdf", "text by Jane Doe", " Given ", "", "de")], "source_file string, text string, given_title string, given_author string, given_language string")
    r = metadata.extract(df).first()
    assert (r.title, r.author, r.language) == ("Given", "Jane Doe", "de")


def test_counters_of_the_cleaner(spark):
    s = "<b>“ﬁne”</b>​\n12\n  a—b &amp;lt; \x07"
    r = t.clean_llm_with_stats(spark.createDataFrame([(s,), ("",), (None,)], "s string"), "s").collect()
    assert (r[0].clean, r[0].html_tags_removed, r[0].smart_quotes_replaced, r[0].ligatures_expanded, r[0].control_chars_removed, r[0].page_numbers_removed) == ('"fine"\n a - b &amp;lt;', 2, 2, 0, 2, 1)
    assert (r[1].clean, r[2].clean, r[1].reduction_percent) == ("", "", 0.0)
    flags = spark.createDataFrame([(s,)], "s string").select(t.clean_llm(F.col("s"), quote=False, html=False, page_numbers=False).alias("o")).first().o
    assert flags.startswith("<b>“fine”</b>\n12\n")


def test_embeddings_and_models_behind_ports(spark):
    from quirespark.operators import detection

    def load():
        return lambda texts: [[float(len(x)), 1.0] for x in texts]

    c = spark.createDataFrame([(1, "abc", None, None), (2, None, None, None), (3, "x", [9.0], "old")], "id int, content string, embedding array<float>, embedding_model string")
    got = {r.id: (r.embedding, r.embedding_model) for r in semantic.embed_missing(c, load, "m").collect()}
    assert got == {1: ([3.0, 1.0], "m"), 2: (None, None), 3: ([9.0], "old")}
    assert {r.id: r.embedding_model for r in semantic.embed_missing(c, load, "m", force=True).collect()} == {1: "m", 2: None, 3: "m"}
    r = spark.createDataFrame([(1, "t", 0.3), (2, None, 0.45), (3, "u", 0.9)], "book_id int, text string, confidence double")
    asked = {x.book_id: (round(x.confidence, 2), x.advice) for x in detection.ask_when_unsure(r, lambda b, t, c: (0.6, f"{b}:{t}")).collect()}
    assert asked == {1: (0.9, "1:t"), 2: (1.0, "2:"), 3: (0.9, None)}
    assert {x.advice for x in detection.ask_when_unsure(r, None).collect()} == {None}


def test_formats_options_and_progress(spark, tmp_path, monkeypatch):
    from quirespark import api
    from quirespark.streaming import ingest

    row = spark.range(1).select(t.with_commas(F.lit(1234567)).alias("a"), t.percent(F.lit(0.125)).alias("b"), t.percent(F.lit(0.1234), 1).alias("c"), t.stable_id(F.lit("x"), F.lit(1)).alias("d"), t.stable_id(F.lit("x1")).alias("e")).first()
    assert row[:3] == ("1,234,567", "12%", "12.3%") and row.d != row.e and len(row.d) == 32
    (tmp_path / "o.json").write_text('{"merge": true, "section_patterns": ["Q: .+"]}')
    monkeypatch.setenv("QUIRESPARK_CONFIG", str(tmp_path / "o.json"))
    assert api.load_options() == api.Options(merge=True, section_patterns=("Q: .+",))
    seen = []
    listener = ingest.Progress(lambda name, batch, rows: seen.append((name, rows)))
    spark.streams.addListener(listener)
    q = spark.readStream.format("rate").option("rowsPerSecond", 5).load().writeStream.format("noop").queryName("p").start()
    for _ in range(60):
        q.awaitTermination(0.5)
        if seen:
            break
    q.stop()
    spark.streams.removeListener(listener)
    assert seen and seen[0][0] == "p"
    df = spark.createDataFrame([(1, 0, "$ run it"), (1, 1, "$ run me"), (1, 2, "prose here")], "book_id int, line_index int, line string")
    assert [r.line_index for r in ln.non_code_lines(df).collect()] == [2]

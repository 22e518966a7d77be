"""Text scalars over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import storage
from ..sources.tables import read

#: Added to each text, the same on both sides.
NOISE = " “double” ‘single’ «guillemets» a–b c—d e−f ﬁve œuvre … • → ≥ x&lt;y &amp; <b>bold</b>\n  12  \nPage 7\n- 8 -\n3 of 9\n\n\n\nend **strong** `code` https://a.b/c me@x.org \x07 &amp;lt;i&amp;gt;\r\nnext\r\n\r\n\r\nno\u00a0break\u2003em zero\u200bwidth soft\u00adhyphen"
_SQL_NOISE = "'" + NOISE.replace("\n", "' || chr(10) || '").replace("\r", "' || chr(13) || '").replace("\x07", "' || chr(7) || '") + "'"
BASE = f"(SELECT doc_id, text || {_SQL_NOISE} AS s FROM documents)"
TITLES = "(SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'Chapter ' || doc_id || ': The Great River' WHEN 1 THEN doc_id || '. Getting Started' WHEN 2 THEN 'Summary' WHEN 3 THEN '1.2 Title \"quoted\": part/one' WHEN 4 THEN 'Section ' || doc_id WHEN 5 THEN 'Über die  Brücke (neu)' WHEN 6 THEN 'appendix' ELSE doc_id || ' Rivers And Roads' END AS s FROM documents)"


def _noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    t.bound_batches(spark)
    return read(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(NOISE)).alias("s"))


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = read(spark, sf_dir, "documents"), F.col("doc_id") % 8
    s = (
        F.when(i == 0, F.concat(F.lit("Chapter "), "doc_id", F.lit(": The Great River")))
        .when(i == 1, F.concat("doc_id", F.lit(". Getting Started")))
        .when(i == 2, "Summary")
        .when(i == 3, '1.2 Title "quoted": part/one')
        .when(i == 4, F.concat(F.lit("Section "), "doc_id"))
        .when(i == 5, "Über die  Brücke (neu)")
        .when(i == 6, "appendix")
        .otherwise(F.concat("doc_id", F.lit(" Rivers And Roads")))
    )
    return d.select("doc_id", s.alias("s"))


def _of(source, f) -> callable:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return source(spark, sf_dir).select("doc_id", f(F.col("s")).alias("out"))

    return query


def _sql_replace(s: str, table: dict[str, str]) -> str:
    for k, v in table.items():
        quoted = v.replace("'", "''")
        s = f"replace({s}, '{k}', '{quoted}')"
    return s


def _lit(x: str) -> str:
    return x.replace("'", "''")


_PAGE = "|".join(f"(?:{p})" for p in t.PAGE_LINES)
#: White space in Unicode's sense but for the line end, as a class of a regular expression.
_SPACE = r"\t\r\f\v " + "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_STRIP = rf"regexp_replace({{}}, '^[{_SPACE}\n]+|[{_SPACE}\n]+$', '', 'g')"
_LLM_WS = _STRIP.replace("{}", rf"regexp_replace(regexp_replace(regexp_replace({{}}, '[{_SPACE}]+', ' ', 'g'), ' +\n', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")
_PAGES_OUT = "array_to_string(list_filter(string_split({}, chr(10)), lambda x: NOT regexp_matches(x, '" + _PAGE + "')), chr(10))"
_MARKUP = "regexp_replace(replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#\\d+;', '', 'g')"
_CONTROL = r"regexp_replace({}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')"
_BASIC_WS = _STRIP.replace("{}", rf"array_to_string(list_transform(string_split(regexp_replace(regexp_replace({{}}, '[{_SPACE}]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), chr(10)), lambda x: trim(x)), chr(10))")
_LLM_CONTROL = r"regexp_replace({}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}\p{Cf}\p{Co}]', '', 'g')"
#: The compatibility forms of what NOISE holds; the documents are composed already.
_NFKC = _sql_replace("nfc_normalize({})", {"ﬁ": "fi", "…": "...", "\u00a0": " ", "\u2003": " "})
_BARE = "array_to_string(list_transform(string_split({}, chr(10)), lambda x, i: CASE WHEN i > 600 AND regexp_matches(x, '^\\s*\\d+\\s*$') THEN '' ELSE x END), chr(10))"
_Q = _sql_replace("{}", t.QUOTES)
_LIG = _sql_replace("{}", t.LIGATURES)
_SYM = _sql_replace("{}", t.SYMBOLS)


def _nest(*steps: str) -> str:
    out = "s"
    for step in steps:
        out = step.replace("{}", out)
    return out


_LLM = _nest(_NFKC, "regexp_replace({}, '<[^>]+>', '', 'g')", _LIG, _Q, _sql_replace("{}", t.LLM_DASHES), _SYM, _LLM_CONTROL, _PAGES_OUT, _LLM_WS)
_EMBED = _STRIP.replace(
    "{}", f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_LLM}, '\\*\\*(.+?)\\*\\*', '\\1', 'g'), '\\*(.+?)\\*', '\\1', 'g'), '`(.+?)`', '\\1', 'g'), '(?m)^#+\\s*', '', 'g'), 'https?://\\S+', '', 'g'), '\\S+@\\S+\\.\\S+', '', 'g')"
)


def _sql(expr: str, source: str = BASE) -> str:
    return f"SELECT doc_id, {expr} AS out FROM {source} b"


def _scalar(name: str, f, sql: str, source=_noisy, base: str = BASE) -> tuple:
    return name, (_of(source, f), _sql(sql, base))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.clean_llm_with_stats(_noisy(spark, sf_dir), "s").drop("s", "clean").withColumn("reduction_percent", F.round("reduction_percent", 6))


def _stats_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.clean_basic_with_stats(_noisy(spark, sf_dir), "s").drop("s", "clean")


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.clean_llm_with_stats(_noisy(spark, sf_dir), "s").select("doc_id", t.cleaning_report().alias("report"))


def _count_sql(table: dict[str, str], of: str) -> str:
    return f"(length({of}) - length(translate({of}, '{''.join(table)}', '')))::INTEGER"


_STEPS = (
    f"WITH a AS (SELECT doc_id, s, {_nest(_NFKC)} AS s1 FROM {BASE} b), h AS (SELECT *, regexp_replace(s1, '<[^>]+>', '', 'g') AS s2 FROM a), m AS (SELECT *, {_nest(_LIG, _Q, _sql_replace('{}', t.LLM_DASHES), _SYM)} AS s3 FROM (SELECT * EXCLUDE (s), s AS s0, s2 AS s FROM h)), "
    f"c AS (SELECT * EXCLUDE (s), s3 AS s FROM m), d AS (SELECT *, {_nest(_LLM_CONTROL)} AS s4 FROM c), p AS (SELECT * EXCLUDE (s), s4 AS s FROM d), q AS (SELECT *, {_nest(_PAGES_OUT)} AS s5 FROM p), r AS (SELECT * EXCLUDE (s), s5 AS s FROM q), w AS (SELECT *, {_nest(_LLM_WS)} AS clean FROM r), "
    f"o AS (SELECT doc_id, length(s0)::INTEGER AS original_length, length(clean)::INTEGER AS cleaned_length, abs(length(s1) - length(s0))::INTEGER AS unicode_normalizations, len(regexp_extract_all(s1, '<[^>]+>'))::INTEGER AS html_tags_removed, {_count_sql(t.LIGATURES, 's2')} AS ligatures_expanded, {_count_sql(t.QUOTES, 's2')} AS smart_quotes_replaced, (length(s3) - length(s4))::INTEGER AS control_chars_removed, (len(string_split(s4, chr(10))) - len(list_filter(string_split(s4, chr(10)), lambda x: NOT regexp_matches(x, '{_PAGE}'))))::INTEGER AS page_numbers_removed, (length(s5) - length(clean))::INTEGER AS whitespace_normalized, (length(s0) - length(clean))::INTEGER AS bytes_saved, (length(s0) - length(clean)) * 100.0::DOUBLE / length(s0) AS reduction_percent FROM w)"
)
_STEPS_BASIC = (
    f"WITH a AS (SELECT doc_id, s AS s0, {_nest(_MARKUP)} AS s1 FROM {BASE} b), c AS (SELECT *, {_NFKC.replace('{}', 's1')} AS s FROM a), d AS (SELECT *, s AS s2, {_nest(_Q, _sql_replace('{}', t.BASIC_DASHES))} AS s3 FROM c), e AS (SELECT * EXCLUDE (s), s3 AS s FROM d), f AS (SELECT *, {_nest(_CONTROL)} AS s4 FROM e), g AS (SELECT * EXCLUDE (s), s4 AS s FROM f) "
    f"SELECT doc_id, length(s0)::INTEGER AS original_length, length({_nest(_BARE, _BASIC_WS)})::INTEGER AS final_length, (length(s0) - length(s1))::INTEGER AS markup_removed, {_count_sql(t.QUOTES, 's2')} AS quotes_normalized, {_count_sql(t.BASIC_DASHES, 's2')} AS dashes_normalized, (length(s3) - length(s4))::INTEGER AS control_chars_removed FROM g"
)
_REPORT = " || ".join(
    [
        "'Text Cleaning Report' || chr(10) || '====================' || chr(10) || 'Original length: ' || format('{:,}', original_length) || ' chars' || chr(10) || 'Cleaned length:  ' || format('{:,}', cleaned_length) || ' chars' || chr(10) || 'Bytes saved:     ' || format('{:,}', bytes_saved) || ' (' || printf('%.1f', reduction_percent) || '%)' || chr(10) || chr(10) || 'Changes:' || chr(10)",
        *[f"'- {label:<24}' || {column} || chr(10)" for label, column in (("Unicode normalizations:", "unicode_normalizations"), ("Smart quotes replaced:", "smart_quotes_replaced"), ("HTML tags removed:", "html_tags_removed"), ("Control chars removed:", "control_chars_removed"), ("Ligatures expanded:", "ligatures_expanded"), ("Page numbers removed:", "page_numbers_removed"), ("Whitespace normalized:", "whitespace_normalized"))],
    ]
)


def _html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", t.html_title(F.col("html")).alias("title"))


_TITLE_OF = "nullif(trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<{0}[^>]*>(.*?)</{0}>', 1), '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')), '')"


def _render(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text").join(_titles(spark, sf_dir), "doc_id")
    body = storage.render_section(F.col("s"), F.col("doc_id"), t.estimate_tokens(F.col("text")), t.word_count(F.col("text")), F.col("text"))
    return d.select("doc_id", storage.file_name(F.col("doc_id") % 100, F.lit("Part One: the Start")).alias("file_name"), body.alias("body"), F.sha2(body, 256).alias("content_hash"))


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", t.resolve_path(F.lit("OEBPS/text"), F.concat(F.lit("../img/./a"), "doc_id", F.lit(".png"))).alias("path"))


def _titles_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _titles(spark, sf_dir)
    b = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Chapter "), "doc_id", F.lit(": The Long Road"))).otherwise(F.lit("Summary")).alias("other"))
    return a.join(b, "doc_id").select("doc_id", t.titles_match(F.col("s"), F.col("other")).alias("same"))


_WORDS = "list_filter(regexp_split_to_array({}, '[" + _SPACE + "\\n]+'), lambda w: w <> '')"
CATALOG = dict(
    [
        _scalar("fn_word_count", t.word_count, f"len({_WORDS.format('s')})::INTEGER"),
        _scalar("fn_estimate_tokens", lambda s: t.estimate_tokens(s).cast("long"), "(length(s) // 4)::BIGINT"),
        _scalar("basic_quotes", t.quotes, _nest(_Q)),
        _scalar("llm_quotes", t.quotes, _nest(_Q)),
        _scalar("basic_dashes", t.basic_dashes, _sql_replace("s", t.BASIC_DASHES)),
        _scalar("llm_dashes", t.llm_dashes, _sql_replace("s", t.LLM_DASHES)),
        _scalar("llm_ligatures", t.ligatures, _nest(_LIG)),
        _scalar("llm_symbols", t.symbols, _nest(_SYM)),
        _scalar("basic_control", t.basic_control, _nest(_CONTROL)),
        _scalar("llm_control", t.llm_control, _nest(_LLM_CONTROL)),
        _scalar("basic_strip_markup", t.basic_strip_markup, _nest(_MARKUP)),
        _scalar("llm_strip_html", t.llm_strip_html, "regexp_replace(s, '<[^>]+>', '', 'g')"),
        _scalar(
            "basic_page_numbers",
            lambda s: t.basic_page_numbers(s, 2),
            "array_to_string(list_transform(string_split(s, chr(10)), lambda x, i: CASE WHEN i > 2 AND regexp_matches(x, '^\\s*\\d+\\s*$') THEN '' ELSE x END), chr(10))",
        ),
        _scalar("llm_page_numbers", t.llm_page_numbers, _nest(_PAGES_OUT)),
        _scalar("basic_whitespace", t.basic_whitespace, _nest(_BASIC_WS)),
        _scalar("llm_whitespace", t.llm_whitespace, _nest(_LLM_WS)),
        _scalar(
            "clean_basic",
            t.clean_basic,
            _nest(_MARKUP, _NFKC, _Q, _sql_replace("{}", t.BASIC_DASHES), _CONTROL, _BARE, _BASIC_WS),
        ),
        _scalar("clean_llm", t.clean_llm, _LLM),
        _scalar("clean_for_embedding", t.clean_for_embedding, _EMBED),
        _scalar("llm_nfkc", t.nfkc, _nest(_NFKC)),
        ("cleaning_stats", (_stats, f"{_STEPS} SELECT * REPLACE (round(reduction_percent, 6) AS reduction_percent) FROM o")),
        ("cleaning_stats_basic", (_stats_basic, _STEPS_BASIC)),
        ("cleaning_report", (_report, f"{_STEPS} SELECT doc_id, {_REPORT} AS report FROM o")),
        _scalar("fn_escape_yaml", t.escape_yaml, "replace(replace(s, '\"', '\\\"'), chr(10), ' ')", _titles, TITLES),
        _scalar("fn_sanitize_filename", t.sanitize_filename, "substr(lower(regexp_replace(regexp_replace(regexp_replace(s, '[^\\p{L}\\p{N}_\\s\\-.]', '', 'g'), '\\s+', '-', 'g'), '-+', '-', 'g')), 1, 100)", _titles, TITLES),
        _scalar("fn_normalize_for_matching", t.normalize_for_matching, "trim(lower(regexp_replace(regexp_replace(s, '[-–—:]', ' ', 'g'), '\\s+', ' ', 'g')))", _titles, TITLES),
        _scalar("fn_normalize_title", t.normalize_title, "trim(lower(regexp_replace(s, '(?i)^chapter\\s+\\d+[:\\s]*', '')))", _titles, TITLES),
        _scalar(
            "fn_is_title_case",
            t.is_title_case,
            f"len({_WORDS.format('s')}) BETWEEN 2 AND 10 AND NOT regexp_matches(s, '[=<>{{}}()\\[\\]]') AND len(list_filter({_WORDS.format('s')}, lambda w: length(w) > 3)) > 0 AND len(list_filter({_WORDS.format('s')}, lambda w: length(w) > 3 AND upper(w[1]) = w[1] AND lower(w[1]) <> w[1])) >= 0.7 * len(list_filter({_WORDS.format('s')}, lambda w: length(w) > 3))",
            _titles,
            TITLES,
        ),
        _scalar("fn_is_subsection_title", t.is_subsection_title, "regexp_matches(trim(s), '" + t.SUBSECTION + "')", _titles, TITLES),
        _scalar("fn_extract_chapter_number", t.chapter_number, "coalesce(nullif(regexp_extract(s, '(?i)^chapter\\s+(\\d+)', 1), ''), nullif(regexp_extract(s, '^(\\d+)\\.\\s+', 1), ''), nullif(regexp_extract(s, '(?i)^(\\d+)\\s+[A-Z]', 1), ''))::INTEGER", _titles, TITLES),
        _scalar("fn_clean_section_title", t.clean_section_title, "substr(trim(regexp_replace(regexp_replace(regexp_replace(trim(s), '^#+\\s*', ''), '[:.]+$', ''), '\\s+', ' ', 'g')), 1, 80)", _titles, TITLES),
        _scalar("fn_should_skip_title", t.should_skip_title, "regexp_matches(trim(s), '" + t.SKIPPED_TITLES + "')", _titles, TITLES),
        (
            "fn_titles_match",
            (
                _titles_match,
                f"WITH x AS (SELECT doc_id, s, CASE WHEN doc_id % 2 = 0 THEN 'Chapter ' || doc_id || ': The Long Road' ELSE 'Summary' END AS o FROM {TITLES} b), y AS (SELECT *, {_WORDS.format('s')} AS a, {_WORDS.format('o')} AS c, greatest(3, floor(0.6::DOUBLE * least(length(s), length(o)))::INTEGER) AS n FROM x) SELECT doc_id, s = o OR (len(a) >= 3 AND len(c) >= 3 AND a[1:3] = c[1:3]) OR (length(s) >= n AND length(o) >= n AND substr(s, 1, n) = substr(o, 1, n)) AS same FROM y",
            ),
        ),
        ("fn_extract_html_title", (_html_title, "SELECT page_id, coalesce(CASE WHEN length(h1) < 200 THEN h1 END, CASE WHEN length(h2) < 200 THEN h2 END, CASE WHEN length(ti) < 200 THEN ti END) AS title FROM (SELECT page_id, " + ", ".join(f"{_TITLE_OF.replace('{0}', x)} AS {y}" for x, y in (("h1", "h1"), ("h2", "h2"), ("title", "ti"))) + " FROM pages)")),
        ("fn_resolve_path", (_paths, "SELECT doc_id, 'OEBPS/img/a' || doc_id || '.png' AS path FROM documents")),
        (
            "render_section",
            (
                _render,
                "WITH r AS (SELECT d.doc_id, lpad((d.doc_id % 100)::VARCHAR, 2, '0') || '-part-one-the-start.md' AS file_name, '---' || chr(10) || 'title: \"' || replace(b.s, '\"', '\\\"') || '\"' || chr(10) || 'chapter: ' || d.doc_id || chr(10) || 'tokens: ' || (length(d.text) // 4) || chr(10) || 'words: ' || len("
                + _WORDS.format("d.text")
                + f") || chr(10) || '---' || chr(10) || chr(10) || '# ' || b.s || chr(10) || chr(10) || '**Chapter ' || d.doc_id || '** | *' || format('{{:,}}', len(" + _WORDS.format("d.text") + f")) || ' words* | *~' || format('{{:,}}', length(d.text) // 4) || ' tokens*' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || d.text AS body FROM documents d JOIN {TITLES} b ON d.doc_id = b.doc_id) SELECT doc_id, file_name, body, sha256(body) AS content_hash FROM r",
            ),
        ),
    ]
)

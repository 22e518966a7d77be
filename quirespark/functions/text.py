"""Text scalars as Column -> Column, so that Catalyst sees through them.

Two cleaners exist side by side, as readers of old libraries depend on either:
``basic_*`` keeps the shape of a page, ``llm_*`` prepares text for models.
"""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .folds import bind

if TYPE_CHECKING:
    import pyarrow as pa

#: Text that is composed at once in a Python worker, and bytes of a batch that it gets.
NFKC_BYTES, BATCH_BYTES = 1 << 20, 4 << 20
# Typographic characters and what they become.
QUOTES = {
    "\u201c": '"', "\u201d": '"', "\u2018": "'", "\u2019": "'", "\u201e": '"',
    "\u201f": '"', "\u00ab": '"', "\u00bb": '"', "\u2039": "'", "\u203a": "'",
}
BASIC_DASHES = {"\u2013": "-", "\u2014": "--", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2015": "--"}
LLM_DASHES = {"\u2013": "-", "\u2014": " - ", "\u2212": "-", "\u2010": "-", "\u2011": "-", "\u2012": "-"}
LIGATURES = {
    "\ufb01": "fi", "\ufb02": "fl", "\ufb00": "ff", "\ufb03": "ffi", "\ufb04": "ffl",
    "\u0132": "IJ", "\u0133": "ij", "\u0153": "oe", "\u0152": "OE", "\u00e6": "ae", "\u00c6": "AE",
}
SYMBOLS = {
    "…": "...", "•": "*", "◦": "o", "●": "*", "○": "o", "■": "*", "□": "o", "▪": "*", "→": "->", "←": "<-",
    "↔": "<->", "⇒": "=>", "≥": ">=", "≤": "<=", "≠": "!=", "×": "x", "÷": "/", "±": "+/-", "√": "sqrt", "∞": "infinity",
}
#: Lines that hold nothing but a page's number or running head.
PAGE_LINES = (
    r"^\s*\d{1,4}\s*$",
    r"^\s*[Pp]age\s+\d{1,4}\s*$",
    r"^\s*[-–—]\s*\d{1,4}\s*[-–—]\s*$",
    r"^\s*\d{1,4}\s+of\s+\d{1,4}\s*$",
    r"^\s*\d{1,4}\s+Chapter\s+\d+",
    r"^\s*Chapter\s+\d+.*\|\s*\d{1,4}\s*$",
)
BARE_NUMBER = r"^\s*\d+\s*$"
FIRST_PAGE_LINE = 600  # lines before this belong to a table of contents


def words(s: Column) -> Column:
    """Runs of characters that aren't white space, in Unicode's sense."""
    return F.filter(F.split(s, r"(?U)\s+"), lambda w: w != "")


def word_count(s: Column) -> Column:
    return F.coalesce(F.size(words(s)), F.lit(0))


def estimate_tokens(s: Column) -> Column:
    return F.floor(F.length(s) / 4)


def tokens_of_words(n: Column) -> Column:
    return F.floor(n / F.lit(0.75))


def replace_all(s: Column, table: dict[str, str]) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), table.items(), s)


def count_chars(s: Column, chars: str) -> Column:
    return F.length(s) - F.length(F.translate(s, chars, ""))


def quotes(s: Column) -> Column:
    return F.translate(s, "".join(QUOTES), "".join(QUOTES.values()))


def mapped(s: Column, *tables: dict[str, str]) -> Column:
    """``s`` with the characters of the tables replaced; no replacement holds a key.

    What becomes one character is translated in one scan; the rest is replaced
    one by one, in texts that have any of it.
    """
    table = {k: v for t in tables for k, v in t.items()}
    one = {k: v for k, v in table.items() if len(v) == 1}
    many = {k: v for k, v in table.items() if len(v) != 1}
    s = F.translate(s, "".join(one), "".join(one.values())) if one else s
    return bind(s, lambda x: F.when(x.rlike(f"[{''.join(many)}]"), replace_all(x, many)).otherwise(x)) if many else s


def basic_dashes(s: Column) -> Column:
    return mapped(s, BASIC_DASHES)


def llm_dashes(s: Column) -> Column:
    return mapped(s, LLM_DASHES)


def ligatures(s: Column) -> Column:
    return mapped(s, LIGATURES)


def symbols(s: Column) -> Column:
    return mapped(s, SYMBOLS)


def basic_control(s: Column) -> Column:
    return F.regexp_replace(s, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def llm_control(s: Column) -> Column:
    return F.regexp_replace(s, r"[\p{C}&&[^\n\t\r]]", "")


def basic_strip_markup(s: Column) -> Column:
    """Tags become a space, then five entities, so that an escaped entity is read twice; numeric ones go."""
    s = F.regexp_replace(s, r"<[^>]+>", " ")
    for name, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')):
        s = F.replace(s, F.lit(name), F.lit(char))
    return F.regexp_replace(s, r"&#\d+;", "")


def llm_strip_html(s: Column) -> Column:
    return F.regexp_replace(s, r"<[^>]+>", "")


def _lines(s: Column) -> Column:
    return F.split(s, "\n")


def basic_page_numbers(s: Column, first: int = FIRST_PAGE_LINE) -> Column:
    """Bare numbers from line ``first`` on become empty lines."""
    return F.array_join(F.transform(_lines(s), lambda x, i: F.when((i >= first) & x.rlike(f"(?U){BARE_NUMBER}"), "").otherwise(x)), "\n")


def is_page_line(line: Column) -> Column:
    return line.rlike(f"(?U)^(?:{'|'.join(p[1:] for p in PAGE_LINES)})")


def llm_page_numbers(s: Column) -> Column:
    return F.array_join(F.filter(_lines(s), lambda x: ~is_page_line(x)), "\n")


def strip(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def basic_whitespace(s: Column) -> Column:
    s = F.regexp_replace(s, r"(?U)[^\S\n]+", " ")
    s = F.regexp_replace(s, r"\n{3,}", "\n\n")
    return strip(F.array_join(F.transform(_lines(s), strip), "\n"))


def llm_whitespace(s: Column) -> Column:
    s = F.regexp_replace(s, r"(?U)[^\S\n]+", " ")
    s = F.regexp_replace(s, r" +\n", "\n")
    return strip(F.regexp_replace(s, r"\n{3,}", "\n\n"))


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Hold the session's Arrow batches to ``most`` bytes or so; a smaller bound stays."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(limit)) > most:
        spark.conf.set(limit, str(most))


def nfkc(s: Column) -> Column:
    """Unicode compatibility composition; Catalyst has no such function.

    On Arrow columns, in slices of about NFKC_BYTES, so that a worker holds a
    batch twice and no more; what the batch took is given back after it. The
    size of batches is the session's (``bound_batches``).
    """
    most = NFKC_BYTES

    def compose(x: pa.Array) -> pa.Array:
        import unicodedata

        import pyarrow as pa

        out, at = [], 0
        while at < len(x):
            n, size = 0, 0
            while at + n < len(x) and (n == 0 or size < most):
                v = x[at + n]
                size += len(v.as_buffer()) if v.is_valid else 0
                n += 1
            out.append(pa.array([None if v is None else unicodedata.normalize("NFKC", v) for v in x.slice(at, n).to_pylist()], pa.string()))
            at += n
        done = pa.concat_arrays(out) if out else pa.array([], pa.string())
        del out
        pa.default_memory_pool().release_unused()
        return done

    return F.arrow_udf(compose, T.StringType(), F.ArrowUDFType.SCALAR)(s)


def clean_basic(s: Column, markup: bool = True, normalize: bool = True, quote: bool = True, dash: bool = True, control: bool = True, page_numbers: bool = True, whitespace: bool = True) -> Column:
    """The steps in their order; each can be left out."""
    s = basic_strip_markup(s) if markup else s
    s = nfkc(s) if normalize else s
    s = quotes(s) if quote else s
    s = basic_dashes(s) if dash else s
    s = basic_control(s) if control else s
    s = basic_page_numbers(s) if page_numbers else s
    return basic_whitespace(s) if whitespace else s


def clean_llm(
    s: Column, normalize: bool = True, quote: bool = True, dash: bool = True, ligature: bool = True, symbol: bool = True, page_numbers: bool = True, html: bool = True, control: bool = True, whitespace: bool = True
) -> Column:
    """The steps in their order; each can be left out."""
    s = nfkc(s) if normalize else s
    s = llm_strip_html(s) if html else s
    # the tables have no character in common, so one pass serves for all
    tables = [t for on, t in ((ligature, LIGATURES), (quote, QUOTES), (dash, LLM_DASHES), (symbol, SYMBOLS)) if on]
    s = mapped(s, *tables) if tables else s
    s = llm_control(s) if control else s
    s = llm_page_numbers(s) if page_numbers else s
    return llm_whitespace(s) if whitespace else s


def _count_of(s: Column, table: dict[str, str]) -> Column:
    return count_chars(s, "".join(table))


def clean_basic_with_stats(df: DataFrame, text: str, out: str = "clean") -> DataFrame:
    """Add the cleaned text and what each step of ``clean_basic`` has changed."""
    t = df.withColumn("__0", F.coalesce(text, F.lit(""))).withColumn("__1", basic_strip_markup(F.col("__0"))).withColumn("__2", nfkc(F.col("__1")))
    t = t.withColumn("__3", basic_dashes(quotes(F.col("__2")))).withColumn("__4", basic_control(F.col("__3")))
    t = t.withColumn(out, basic_whitespace(basic_page_numbers(F.col("__4"))))
    return t.select(
        *df.columns,
        out,
        F.length("__0").alias("original_length"),
        F.length(out).alias("final_length"),
        (F.length("__0") - F.length("__1")).alias("markup_removed"),
        _count_of(F.col("__2"), QUOTES).alias("quotes_normalized"),
        _count_of(F.col("__2"), BASIC_DASHES).alias("dashes_normalized"),
        (F.length("__3") - F.length("__4")).alias("control_chars_removed"),
    )


def clean_llm_with_stats(df: DataFrame, text: str, out: str = "clean") -> DataFrame:
    """Add the cleaned text and what each step of ``clean_llm`` has changed."""
    t = df.withColumn("__0", F.coalesce(text, F.lit(""))).withColumn("__1", nfkc(F.col("__0"))).withColumn("__2", llm_strip_html(F.col("__1")))
    t = t.withColumn("__3", mapped(F.col("__2"), LIGATURES, QUOTES, LLM_DASHES, SYMBOLS)).withColumn("__4", llm_control(F.col("__3")))
    t = t.withColumn("__5", llm_page_numbers(F.col("__4"))).withColumn(out, llm_whitespace(F.col("__5")))
    saved = F.length("__0") - F.length(out)
    return t.select(
        *df.columns,
        out,
        F.length("__0").alias("original_length"),
        F.length(out).alias("cleaned_length"),
        F.abs(F.length("__1") - F.length("__0")).alias("unicode_normalizations"),
        F.regexp_count("__1", F.lit("<[^>]+>")).alias("html_tags_removed"),
        _count_of(F.col("__2"), LIGATURES).alias("ligatures_expanded"),
        _count_of(F.col("__2"), QUOTES).alias("smart_quotes_replaced"),
        (F.length("__3") - F.length("__4")).alias("control_chars_removed"),
        (F.size(_lines(F.col("__4"))) - F.size(F.filter(_lines(F.col("__4")), lambda x: ~is_page_line(x)))).alias("page_numbers_removed"),
        (F.length("__5") - F.length(out)).alias("whitespace_normalized"),
        saved.alias("bytes_saved"),
        F.when(F.length("__0") == 0, 0.0).otherwise(saved * 100.0 / F.length("__0")).alias("reduction_percent"),
    )


def one_decimal(x: Column) -> Column:
    """A number with one decimal, rounded by its exact binary value and half to even, as C's printf does.

    ``format_string`` rounds the shortest decimal form half up: 9.25 and 1.15 (a little less in
    binary) would become 9.3 and 1.2. Twenty times the number is compared with the odd
    number between two results; what the sum 16 x + 4 x loses is kept beside it.
    """
    a = F.abs(x)
    k = F.floor(a * 10)
    p, q = a * 16.0, a * 4.0
    s = p + q
    lost = (p - (s - (s - p))) + (q - (s - p))
    over = s - (k * 2 + 1).cast("double")
    over = F.when(over != 0, over).otherwise(lost)
    tenths = k + F.when((over > 0) | ((over == 0) & (k % 2 == 1)), 1).otherwise(0)
    return F.concat(F.when(x < 0, "-").otherwise(""), F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def cleaning_report(stats: str = "") -> Column:
    """The columns of ``clean_llm_with_stats`` as a text for readers."""

    def number(c: str) -> Column:
        return F.format_string("%,d", F.col(f"{stats}{c}"))

    changes = ("unicode_normalizations", "smart_quotes_replaced", "html_tags_removed", "control_chars_removed", "ligatures_expanded", "page_numbers_removed", "whitespace_normalized")
    head = [
        F.lit("Text Cleaning Report\n====================\nOriginal length: "), number("original_length"),
        F.lit(" chars\nCleaned length:  "), number("cleaned_length"),
        F.lit(" chars\nBytes saved:     "), number("bytes_saved"), F.lit(" ("), one_decimal(F.col(f"{stats}reduction_percent")), F.lit("%)\n\nChanges:\n"),
    ]
    lines = [F.concat(F.lit(f"- {(c.capitalize().replace('_', ' ') + ':').replace('Html', 'HTML'):<24}"), F.col(f"{stats}{c}").cast("string"), F.lit("\n")) for c in changes]
    return F.concat(*head, *lines)


def clean_for_embedding(s: Column, normalize: bool = True) -> Column:
    s = clean_llm(s, normalize)
    s = F.regexp_replace(s, r"\*\*(.+?)\*\*", "$1")
    s = F.regexp_replace(s, r"\*(.+?)\*", "$1")
    s = F.regexp_replace(s, r"`(.+?)`", "$1")
    s = F.regexp_replace(s, r"(?m)^#+\s*", "")
    s = F.regexp_replace(s, r"https?://\S+", "")
    return strip(F.regexp_replace(s, r"\S+@\S+\.\S+", ""))


def escape_yaml(s: Column) -> Column:
    return F.replace(F.replace(s, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit(" "))


def sanitize_filename(s: Column) -> Column:
    s = F.regexp_replace(s, r"(?U)[^\w\s\-.]", "")
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", "-"), r"-+", "-")
    return F.substring(F.lower(s), 1, 100)


def normalize_for_matching(s: Column) -> Column:
    s = F.regexp_replace(s, r"[-–—:]", " ")
    return F.trim(F.lower(F.regexp_replace(s, r"\s+", " ")))


def normalize_title(s: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(s, r"(?i)^chapter\s+\d+[:\s]*", "")))


def is_title_case(s: Column) -> Column:
    w = words(s)
    long = F.filter(w, lambda x: F.length(x) > 3)
    upper = F.filter(long, lambda x: (F.upper(F.substring(x, 1, 1)) == F.substring(x, 1, 1)) & (F.lower(F.substring(x, 1, 1)) != F.substring(x, 1, 1)))
    return F.size(w).between(2, 10) & ~s.rlike(r"[=<>{}()\[\]]") & (F.size(long) > 0) & (F.size(upper) >= F.size(long) * 0.7)


def titles_match(a: Column, b: Column) -> Column:
    """Equal, or alike in the first three words or the first 60 percent of the shorter."""
    wa, wb = words(a), words(b)
    three = (F.size(wa) >= 3) & (F.size(wb) >= 3) & (F.slice(wa, 1, 3) == F.slice(wb, 1, 3))
    need = F.greatest(F.lit(3), F.floor(F.least(F.length(a), F.length(b)) * F.lit(0.6)).cast("int"))
    prefix = (F.length(a) >= need) & (F.length(b) >= need) & (F.substr(a, F.lit(1), need) == F.substr(b, F.lit(1), need))
    return (a == b) | three | prefix


#: Titles of parts of a chapter rather than chapters; fixed values.
SUBSECTIONS = (
    r"^Section\s+\d+$",
    r"^\d+(\.\d+)+\s+",
    r"^Part\s+[IVX]+\s*$",
    r"^Getting\s+Started",
    r"^Introduction\s*$",
    r"^Preface\s*$",
    r"^Foreword\s*$",
    r"^Acknowledgments?\s*$",
    r"^Summary\s*$",
    r"^Conclusion\s*$",
    r"^Review\s*$",
)
SUBSECTION = "(?i)" + "|".join(f"(?:{p})" for p in SUBSECTIONS)


def is_subsection_title(s: Column) -> Column:
    return F.trim(s).rlike(SUBSECTION)


def chapter_number(s: Column) -> Column:
    def first(pattern: str) -> Column:
        return F.when(F.regexp_extract(s, pattern, 1) != "", F.regexp_extract(s, pattern, 1))

    return F.coalesce(first(r"(?i)^chapter\s+(\d+)"), first(r"^(\d+)\.\s+"), first(r"(?i)^(\d+)\s+[A-Z]")).try_cast("int")


def clean_section_title(s: Column) -> Column:
    s = F.regexp_replace(F.trim(s), r"^#+\s*", "")
    s = F.regexp_replace(s, r"[:.]+$", "")
    return F.substring(F.trim(F.regexp_replace(s, r"\s+", " ")), 1, 80)


#: Titles of front and back matter; fixed values.
SKIPPED_TITLES = (
    r"(?i)^(cover|cover page|title|title page|copyright|contents|toc|table of contents|dedication|acknowledgments?|preface|foreword|"
    r"about the authors?|about this book|index|glossary|bibliography|appendix|colophon|front matter|back matter|half title|full title|"
    r"also by|praise for|endorsements|notes|references|who this book is for|what this book covers|how to read this book|conventions used|"
    r"get in touch|code in action|to get the most out of this book|download|errata|piracy|other books you may enjoy|share your thoughts)$"
)


def should_skip_title(s: Column) -> Column:
    return F.trim(s).rlike(SKIPPED_TITLES)


def html_title(html: Column) -> Column:
    """Text of the first of h1, h2 and title that is shorter than 200."""

    def of(tag: str) -> Column:
        raw = F.regexp_extract(html, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)
        text = F.trim(F.regexp_replace(F.regexp_replace(raw, r"<[^>]+>", ""), r"\s+", " "))
        return F.when((text != "") & (F.length(text) < 200), text)

    return F.coalesce(of("h1"), of("h2"), of("title"))


def resolve_path(base: Column, href: Column) -> Column:
    """``href`` against the folder ``base``, with . and .. taken out."""
    parts = F.split(F.concat_ws("/", base, href), "/")
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p.isin("", "."), acc).when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p))),
    )
    return F.array_join(folded, "/")


def confidence_level(x: Column) -> Column:
    return F.when(x >= 0.7, "high").when(x >= 0.4, "medium").otherwise("low")


def method_confidence(level: Column) -> Column:
    return F.when(level == "high", 0.9).when(level == "medium", 0.7).when(level == "low", 0.4).otherwise(0.5)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; 0 where one has no length."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, F.lit(0.0)).otherwise(dot(a, b) / norm)


def sentences(s: Column) -> Column:
    return F.split(s, r"(?<=[.!?])\s+")


def strip_frontmatter(s: Column) -> Column:
    """What follows a leading block between lines of three dashes."""
    parts = F.split(s, "---", 3)
    return F.when(s.startswith("---") & (F.size(parts) == 3), strip(parts[2])).otherwise(s)


def with_commas(n: Column) -> Column:
    return F.format_string("%,d", n.cast("long"))


def percent(share: Column, digits: int = 0) -> Column:
    """A share as a percentage, rounded half to even."""
    return F.concat(F.format_string(f"%.{digits}f", F.bround(share * 100, digits)), F.lit("%"))


def timestamp_text(at: Column | None = None) -> Column:
    """A time as logs and reports write it; now, if none is given."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd HH:mm:ss")


def stable_id(*parts: Column) -> Column:
    """An id that a rerun gives again, unlike a random one."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]), 256), 1, 32)

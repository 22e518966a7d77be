"""Secrets in text: fixed patterns, and runs of high entropy.

Patterns (``assign``, ``access``, ``hex``) are found leftmost and without
overlap, each kind on its own, and dropped where the secret is too short. A
match's span is the whole match, in code points, end exclusive.

Entropy: candidate strings are maximal runs of the characters of keys. A window
of WINDOW characters slides over a candidate, its character counts kept up by
one added and one removed character a step, and with them the Shannon entropy
and the narrowest character class that holds the window. The
windows at or above the threshold of their class are merged into
spans of kind ``entropy``. An allow-list suppresses candidates that are no
secrets (UUIDs, numbers and dates, words joined by signs, alphabets, paths), and
windows whose letters read like words: COMMON_PAIRS make up a good part of their
pairs of letters. Of random keys of WINDOW characters each class finds about 98 %,
and more of longer ones. Spans of entropy are given inside those of patterns, too.

Defined results: a null or empty text has no spans; equal texts have equal
spans; rows are kept one to one, whatever the other columns hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns

KINDS = ("assign", "access", "hex", "entropy")
BASE = KINDS[:3]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: A text without any of these in lower case has no assignment.
_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

WINDOW = 20
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Character classes, narrowest first, and the bits a character that a window
#: needs: about the 2nd percentile of random windows of the class.
CLASSES = (
    ("hex", _DIGITS + "abcdef", 2.95),
    ("HEX", _DIGITS + "ABCDEF", 2.95),
    ("mixed hex", _DIGITS + "abcdefABCDEF", 3.15),
    ("lower", _LOWER, 3.25),
    ("upper", _UPPER, 3.25),
    ("lower alnum", _DIGITS + _LOWER, 3.4),
    ("upper alnum", _DIGITS + _UPPER, 3.4),
    ("letters", _LOWER + _UPPER, 3.6),
    ("alnum", _DIGITS + _LOWER + _UPPER, 3.65),
    ("base64", _DIGITS + _LOWER + _UPPER + "+/_=-", 3.65),
)
_CLASSES_OF = {c: frozenset(k for k, (_, held, _) in enumerate(CLASSES) if c in held) for c in CLASSES[-1][1]}

#: Pairs of letters that make up half of the text of English, German, French and Spanish.
COMMON_PAIRS = frozenset(
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic "
    "ne ea ra ce li ch ll be ma si om ur el la os ci ei ie un ge sc ss da ue qu et ai us tr ad ac do po em".split()
)
#: Share of the pairs from which letters read like words; random letters have 0.11.
WORDLIKE = 0.3
_LETTERS = re.compile(r"[A-Za-z]+")


def wordlike(s: str) -> bool:
    """Whether the letters of ``s``, of which there are 8 pairs or more, read like words."""
    pairs = [x[i : i + 2] for x in _LETTERS.findall(s.lower()) for i in range(len(x) - 1)]
    return len(pairs) >= 8 and sum(p in COMMON_PAIRS for p in pairs) >= WORDLIKE * len(pairs)


#: Candidates that match one of these whole are no secrets.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"[0-9+/_=-]+"),  # numbers, dates, rules
    re.compile(r"/?([A-Za-z]+[0-9]{0,2}/)+[A-Za-z]*[0-9]{0,2}"),  # paths
    re.compile(r"(?i)[0-9]*abcdefghijklmnopqrstuvwxyz[0-9a-z+/_=-]*"),  # alphabets
    re.compile(r"(?i)0123456789abcdef[0-9a-f]*"),
)
#: And these, if they read like words.
ALLOWED_WORDS = re.compile(r"([A-Z]?[a-z]+|[A-Z]+)([+/_=-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[+/_=-]*")

_CLOG = [0.0, *(c * log2(c) for c in range(1, WINDOW + 1))]


def _windows(s: str) -> Iterator[tuple[int, float]]:
    """(end, sum of c * log2(c) over its character counts c) of every window of ``s``."""
    counts: dict[str, int] = {}
    total = 0.0
    for i, c in enumerate(s):
        k = counts.get(c, 0)
        total += _CLOG[k + 1] - _CLOG[k]
        counts[c] = k + 1
        if i >= WINDOW:
            gone = s[i - WINDOW]
            k = counts[gone]
            total += _CLOG[k - 1] - _CLOG[k]
            counts[gone] = k - 1
        if i >= WINDOW - 1:
            yield i + 1, total


def _most(threshold: float) -> float:
    return (log2(WINDOW) - threshold) * WINDOW + 1e-9


_MOST = tuple(_most(bits) for _, _, bits in CLASSES)


def _merged(ends: Iterable[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for end in ends:
        if out and out[-1][1] >= end - WINDOW:
            out[-1][1] = end
        else:
            out.append([end - WINDOW, end])
    return [(a, b) for a, b in out]


def hot_windows(s: str, threshold: float) -> list[tuple[int, int]]:
    """Merged ranges of ``s`` covered by windows of at least ``threshold`` bits."""
    most = _most(threshold)
    return _merged(end for end, total in _windows(s) if total <= most)


def entropy_spans(s: str) -> list[tuple[int, int]]:
    """Merged ranges covered by windows that are hot for their class and not like words."""

    def ends():
        outside = [-1] * len(CLASSES)  # the last place of a character that isn't of the class
        seen = 0
        for end, total in _windows(s):
            while seen < end:
                held = _CLASSES_OF[s[seen]]
                for k in range(len(CLASSES)):
                    if k not in held:
                        outside[k] = seen
                seen += 1
            k = next(k for k, last in enumerate(outside) if last < end - WINDOW)
            if total <= _MOST[k] and not wordlike(s[end - WINDOW : end]):
                yield end

    return _merged(ends())


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span, by start and then kind as in KINDS."""
    if not text:
        return []
    found = []
    lower = text.encode("utf-8", "surrogatepass").lower()
    if any(k in lower for k in _KEYWORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    for m in _CANDIDATE.finditer(text):
        s = m[0]
        if any(p.fullmatch(s) for p in ALLOWED) or ALLOWED_WORDS.fullmatch(s) and wordlike(s):
            continue
        found += [("entropy", a + m.start(), b + m.start()) for a, b in entropy_spans(s)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def scan(df: DataFrame, text: str = "text", spans: str = "secrets") -> DataFrame:
    """Add the spans of every text: array<struct<kind, start, end>>."""

    def make():
        def f(texts):
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in texts.to_pylist()]
            return [pa.array(rows, pa.list_(_SPAN))]

        return f

    return add_columns(df, [text], [(spans, "array<struct<kind:string,start:int,end:int>>")], make)


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace what ``scan`` finds by ``mark``; touching spans become one mark."""

    def make():
        def f(texts):
            out = []
            for t in texts.to_pylist():
                parts, at = [], 0
                for _, a, b in find(t):
                    if a >= at:
                        parts += [t[at:a], mark]
                    at = max(at, b)
                out.append(t if t is None or not parts else "".join(parts) + t[at:])
            return [pa.array(out, pa.string())]

        return f

    return add_columns(df, [text], [(text, "string")], make)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of every document."""

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(_joined(F.filter("secrets", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )

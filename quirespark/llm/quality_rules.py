"""Quality rules whose cutoffs are chosen under a bound on false rejection.

Counts of a text give the values of RULES (shares and means), and each rule has a
path of cutoffs from lax to strict. Level j of the LEVELS sets all rules to the j-th
cutoff of their paths at once; what a level rejects, every stricter one rejects. The
good documents among the labelled ones that pass the base rules are a stratum's holdout. A level is tested
for the hypothesis "it rejects more than ``alpha`` of the stratum's good documents"
by the exact binomial probability of so few rejections, which is at most ``delta``
where the Clopper-Pearson upper bound is at most ``alpha``. Levels
are tested in their fixed order from the laxest on, and the first that fails ends
the sequence: fixed-sequence testing, in which the probability to certify any
level that rejects more than ``alpha`` stays at ``delta`` whatever the number of
levels. The strictest certified level holds. So in each stratum, with probability
1 - ``delta``, the rules falsely reject at most ``alpha`` of the good documents that
pass the base rules; the base rules are given and take part in no test. With 5 % for
both, 59 good labels without a rejection are the fewest that certify anything.

Every labelled document counts in the holdout and nothing is fitted besides the
level. What leaves the tasks is a histogram: a row for each stratum and
level, whatever the number of documents.

Defined results: a null or empty text has zero words and fails the base rules;
a null stratum is a stratum of its own; labels without a document, with a null
quality or repeated for a document (the lowest quality counts) do no harm;
without labels nothing beyond the base rules rejects.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, checkpoint, ship

_WHITE = " \t\n\r\x0b\x0c"
_SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_text(text: str | None) -> tuple[int, int, int, int, int]:
    """The values of COUNTS for one text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes: ASCII white space only
    chars = len(text) - sum(map(text.count, _WHITE))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_WHITE)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated(words)


def repeated(words: list[bytes]) -> int:
    """Words covered by three-word windows that stand twice or more in the list."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    at = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    k = len(index)
    pair = at[:-1] * k + at[1:]
    if k >= 1 << 20:  # three numbers would not fit into one
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair[:-1] * k + at[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : n - 2 + i] |= twice
    return int(covered.sum())


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add COUNTS (long) of every text."""

    def make():
        def f(texts):
            columns = zip(*map(count_text, texts.to_pylist()), strict=True)
            return [pa.array(c, pa.int64()) for c in columns]

        return f

    return add_columns(df, [text], [(c, "long") for c in COUNTS], make)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def metrics() -> dict[str, Column]:
    """Rules as values that reject where they are high; 0 for texts without words."""

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))

    mean = ratio("word_chars", "n_words")
    return {
        "symbols": ratio("n_symbols", "n_words"),
        "repeats": ratio("n_repeat_words", "n_words"),
        "dup_lines": F.col("n_dup_lines").cast("double"),
        "long_words": mean,
        "short_words": F.lit(20.0) - mean,
    }


#: The path of each rule: its cutoff before the first level and at the last one,
#: with equal steps between. A document is rejected above a cutoff.
RULES = {"symbols": (0.64, 0.0), "repeats": (0.512, 0.0), "dup_lines": (64.0, 0.0), "long_words": (13.0, 5.0), "short_words": (17.6, 14.4)}
LEVELS = 64


def first_level() -> Column:
    """The first level that rejects the document, 1 at least; more than LEVELS if none does."""
    level = None
    for rule, value in metrics().items():
        lax, strict = RULES[rule]
        # cutoff j is lax - (lax - strict) * j / LEVELS
        own = F.floor((F.lit(lax) - value) * (LEVELS / (lax - strict))) + 1
        level = own if level is None else F.least(level, own)
    return F.greatest(level, F.lit(1)).cast("int")


@dataclass(frozen=True)
class Risk:
    alpha: float = 0.05  # share of a stratum's good documents that may be rejected
    delta: float = 0.05  # probability that this fails in a stratum


PRODUCTION = Risk()


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X of n trials with probability p, exactly summed."""
    if k >= n:
        return 1.0
    lp, lq = log(p), log1p(-p)
    logs = [lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * lp + (n - i) * lq for i in range(k + 1)]
    top = max(logs)
    return min(1.0, exp(top) * sum(exp(x - top) for x in logs))


def certified(k: int, n: int, alpha: float, level: float) -> bool:
    """Whether k rejections of n show a rate of at most ``alpha``, at ``level``."""
    return n > 0 and k <= alpha * n and tail(k, n, alpha) <= level


def certified_level(rejects: dict[int, int], n: int, risk: Risk = PRODUCTION) -> tuple[int, int]:
    """The strictest level certified and its rejections; ``rejects``: documents by their first level."""
    level = rejected = 0
    for j in range(1, LEVELS + 1):
        k = rejected + rejects.get(j, 0)
        if not certified(k, n, risk.alpha, risk.delta):
            break
        level, rejected = j, k
    return level, rejected


def thresholds(counted: DataFrame, labels: DataFrame, stratum: str, risk: Risk = PRODUCTION) -> DataFrame:
    """(stratum, level, n_good, n_rejected) of each stratum with good documents; level 0 rejects nothing."""
    good = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("__q")).filter("__q = 1").select("__id")
    held = counted.filter(~base_failed()).join(good, F.col("doc_id") == F.col("__id")).select(F.col(stratum).alias("stratum"), F.least(first_level(), F.lit(LEVELS + 1)).alias("first"))
    histogram = held.groupBy("stratum", "first").agg(F.count("*").alias("n"))

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].sum())
        level, rejected = certified_level(dict(zip(rows["first"].tolist(), rows["n"].tolist(), strict=True)), n, risk)
        return pd.DataFrame({"stratum": [key[0]], "level": [level], "n_good": [n], "n_rejected": [rejected]})

    ship(counted.sparkSession)
    # at most LEVELS + 1 rows for each key
    return histogram.groupBy("stratum").applyInPandas(choose, f"stratum {counted.schema[stratum].dataType.simpleString()}, level int, n_good long, n_rejected long")


def judge(counted: DataFrame, levels: DataFrame, stratum: str) -> DataFrame:
    """Add base_failed and kept; a stratum without a certified level keeps."""
    of = levels.select(F.col("stratum").alias("__s"), F.col("level").alias("__level"))
    out = counted.join(of, F.col(stratum).eqNullSafe(F.col("__s")), "left").withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (first_level() > F.coalesce("__level", F.lit(0)))).drop("__s", "__level")


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: Risk = PRODUCTION) -> DataFrame:
    """doc_id, the stratum, COUNTS, base_failed and kept of every document."""
    counted = checkpoint(counts(docs.select("doc_id", stratum, "text")).drop("text"))
    return judge(counted, thresholds(counted, labels, stratum, risk), stratum)

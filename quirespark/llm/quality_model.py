"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document, or are silent where
a text is too short for their question, which then counts for neither class. They overlap: most
faults of a text are seen by several. Expectation
maximisation over the counts of vote patterns (at most 4 x 3^LABELLERS of them,
whatever the number of documents) estimates how often each labeller says what
on good and on bad documents, and the share of good ones; no true label is
used. The two classes are told apart by where EM starts and by one constraint: no
labeller votes bad more often on good documents than on bad ones, nor good more often on bad
ones. The starting tables weigh ``trust`` documents, whatever the size of the corpus.
The posterior of a document's pattern is its weak label. A logistic
scorer over hashed features of the whole text learns the posteriors from a
bounded sample (``train_rows`` documents, those with the smallest hashes of
their ids; rows without an id are not among them), and scores all documents; a score below ``cutoff`` rejects.

Defined results: null and empty texts get the votes of a text without words and
are scored like any other; equal texts get equal scores; rows are kept one to
one. An empty table gives no rows. With a single vote pattern in the whole
corpus the posterior is the prior. Of rows that share an id the one with the smallest
text by hash may be in the sample.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import isnan, log, nan

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, cache, checkpoint
from .quality_rules import repeated

GOOD, BAD, ABSTAIN, SILENT = 1, 0, 2, 3
DIM = 1 << 14

#: Function words of the corpus languages; fixed values.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for it was on are as with be by this from at or a an "
    "der die und das von zu mit sich des ist im nicht ein eine den dem für auf "
    "le la les de des et en un une du que qui dans pour sur par est au "
    "el los las y que se del por con para una su al lo como".split()
)
_ENDS = re.compile(r"[.!?](?=\s|$)")
_MARKS = re.compile(r"[#*$%&<>@^~=_\\{}\[\]]")


@dataclass(frozen=True)
class Weak:
    train_rows: int = 4000
    em_rounds: int = 100
    epochs: int = 30
    rate: float = 0.5
    l2: float = 1e-5
    cutoff: float = 0.5
    trust: float = 2.0  # documents that the starting tables count as, in each class
    #: P(bad), P(good), P(abstain) of a vote from which EM starts, by class; as many of either.
    start_bad: tuple[float, float, float] = (0.4, 0.4, 0.2)
    start_good: tuple[float, float, float] = (0.05, 0.75, 0.2)


PRODUCTION = Weak()

#: Names of the values that labellers look at, with the value from which a
#: labeller votes bad, and the one up to which it votes good.
LABELLERS: dict[str, tuple[float, float]] = {
    "marks": (0.25, 0.05),  # marks a word
    "bars": (0.2, 0.02),  # bars of tables and menus a word
    "repeats": (0.4, 0.1),  # share of words in repeated windows
    "shouting": (1.0, 0.1),  # share of words in capitals over 0.4, or "!!" a word over 0.2
    "short_lines": (0.7, 0.3),  # share of lines of under three words, of 4 or more
    "few_function_words": (0.88, 0.8),  # share of words that are none
    "signs": (0.13, 0.08),  # share of characters that are no letters
    "capitals": (0.1, 0.05),  # share of letters that are not lower-case
    "sentences": (1.2, 0.7),  # distance of the sentence ends a word from 1/12, as a logarithm
    "sameness": (0.5, 0.4),  # share of words that stand earlier in the text
}
#: Fewer words than this say nothing about shares of words.
LEAST_WORDS = 20


def signals(text: str | None) -> dict[str, float]:
    """The values of LABELLERS for one text; NaN where it is too short to say."""
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    short = sum(len(x.split()) < 3 for x in lines)
    ends = len(_ENDS.findall(text)) / n
    letters = small = functions = 0
    seen = set()
    for w in words:  # most are letters between stops, and need no look at each character
        w = w.strip(".,;:!?")
        low = w.lower()
        seen.add(low)
        functions += low in FUNCTION_WORDS
        if w.isalpha():
            letters += len(w)
            small += len(w) if w == low else sum(map(str.islower, w))
        else:
            letters += sum(map(str.isalpha, w))
            small += sum(map(str.islower, w))
    out = {
        "marks": len(_MARKS.findall(text)) / n,
        "bars": text.count("|") / n,
        "repeats": repeated(text.encode("utf-8", "surrogatepass").split()) / n,
        "shouting": max(sum(1 for w in words if len(w) > 1 and w.isupper()) / n / 0.4, text.count("!!") / n / 0.2),
        "short_lines": short / len(lines) if len(lines) >= 4 else nan,
        "few_function_words": 1 - functions / n,
        "signs": 1 - letters / max(1, sum(map(len, words))),
        "capitals": 1 - small / max(1, letters),
        "sentences": min(3.0, abs(log(ends * 12))) if ends else 3.0,
        "sameness": 1 - len(seen) / n,
    }
    if len(words) < LEAST_WORDS:
        out |= {k: nan for k in ("few_function_words", "signs", "capitals", "sentences", "sameness")}
    return out


def votes(values: dict[str, float]) -> str:
    """One of 0, 1, 2, 3 for each labeller."""
    return "".join(str(SILENT if isnan(values[k]) else BAD if values[k] >= bad else GOOD if values[k] <= good else ABSTAIN) for k, (bad, good) in LABELLERS.items())


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text)


class _Slots(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 1 << 17:
            self.clear()
        x = self[word] = 64 + _hash(word) % (DIM - 64)
        return x


_SLOTS = cache(_Slots())


def features(text: str | None, values: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of the hashed features: words, and the signals in steps."""
    bag: dict[int, float] = {}
    words = (text or "").lower().split()
    for w in map(_SLOTS.__getitem__, words):
        bag[w] = bag.get(w, 0.0) + 1.0
    slots = np.fromiter(bag, np.int32, len(bag))
    x = np.log1p(np.fromiter(bag.values(), np.float32, len(bag)))
    if len(x):
        x *= 0.5 / np.linalg.norm(x)
    steps = [i * 6 + min(5, int(6 * min(1.0, v))) for i, v in enumerate(values.values()) if not isnan(v)]
    return np.concatenate([np.array(steps, np.int32), slots]), np.concatenate([np.ones(len(steps), np.float32), x.astype(np.float32)])


def estimate(patterns: dict[str, int], params: Weak) -> tuple[dict[str, float], float, np.ndarray]:
    """Posterior of good for each vote pattern, the share of good, P(vote | class)."""
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    v = np.array([[int(c) for c in k] for k in keys])
    labellers = range(v.shape[1])
    start = np.zeros((2, v.shape[1], 3))
    start[BAD], start[GOOD] = params.start_bad, params.start_good
    table, share = start.copy(), 0.5
    post = np.zeros(len(keys))
    for _ in range(params.em_rounds):
        log_ = np.log(np.array([1 - share, share])[:, None]) + sum(np.log(np.c_[table[:, j], [1, 1]][:, v[:, j]]) for j in labellers)
        post = 1 / (1 + np.exp(np.clip(log_[0] - log_[1], -700, 700)))
        share = float(((post * n).sum() + 1) / (n.sum() + 2))
        said = np.array([[((v == k) * (w * n)[:, None]).sum(0) for k in range(3)] for w in (1 - post, post)]).transpose(0, 2, 1)
        said += params.trust * start
        table = said / said.sum(2, keepdims=True)
        # where a labeller would say it more often of the wrong class, it says it equally often of both
        for vote, right in ((BAD, BAD), (GOOD, GOOD)):
            for j in np.nonzero(table[right, :, vote] < table[1 - right, :, vote])[0]:
                p = said[:, j, vote].sum() / said[:, j].sum()
                table[:, j] *= ((1 - p) / (1 - table[:, j, vote]))[:, None]
                table[:, j, vote] = p
    return dict(zip(keys, post.tolist(), strict=True)), share, table


def train(slots: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, params: Weak) -> np.ndarray:
    """Weights (the last is the bias) of a logistic scorer, by Adagrad on soft labels."""
    w, g = np.zeros(DIM + 1), np.full(DIM + 1, 1e-8)
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(params.epochs):
        for i in order.permutation(len(slots)):
            s, x = slots[i], values[i]
            z = float(w[s] @ x + w[DIM])
            d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[i]
            step = d * x + params.l2 * w[s]
            np.add.at(g, s, step * step)
            g[DIM] += d * d
            np.subtract.at(w, s, params.rate * step / np.sqrt(g[s]))
            w[DIM] -= params.rate * d / np.sqrt(g[DIM])
    return w


def add_votes(docs: DataFrame) -> DataFrame:
    def make():
        def f(texts):
            return [pa.array([votes(signals(t)) for t in texts.to_pylist()], pa.string())]

        return f

    return add_columns(docs, ["text"], [("votes", "string")], make)


def _sample(docs: DataFrame, voted: DataFrame, params: Weak) -> list:
    """(votes, slots, values) of at most ``train_rows`` documents, in a fixed order."""
    ids = voted.select("doc_id", F.xxhash64(F.lit("train"), "doc_id").alias("h")).orderBy("h", "doc_id").limit(params.train_rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # train_rows bounds the broadcast

    def make():
        def f(texts):
            rows = []
            for t in texts.to_pylist():
                values = signals(t)
                rows.append((votes(values), *features(t, values)))
            return [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                pa.array([r[2] for r in rows], pa.list_(pa.float32())),
            ]

        return f

    shaped = add_columns(chosen.select("h", "doc_id", "text"), ["text"], [("votes", "string"), ("slots", "array<int>"), ("x", "array<float>")], make)
    rows = shaped.select("h", "doc_id", "votes", "slots", "x").groupBy("h", "doc_id").agg(F.min_by(F.struct("votes", "slots", "x"), F.xxhash64("votes", "slots", "x")).alias("s")).select("h", "doc_id", "s.*").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["h"], r["doc_id"] is None, r["doc_id"] or 0))
    return [(r["votes"], np.array(r["slots"], np.int32), np.array(r["x"], np.float32)) for r in rows[: params.train_rows]]


def classify(docs: DataFrame, params: Weak = PRODUCTION) -> DataFrame:
    """``docs`` with ``votes``, ``posterior``, ``score`` and ``kept``.

    A column of ``docs`` with one of these names is replaced.
    """
    voted = checkpoint(add_votes(docs.select("doc_id", "text")).select("doc_id", "votes"))
    patterns = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}  # at most 4 x 3^10 rows
    posterior, share, _ = estimate(patterns, params) if patterns else ({}, 0.5, None)
    sample = _sample(docs, voted, params)
    target = np.array([posterior[v] for v, _, _ in sample])
    weights = train([s for _, s, _ in sample], [x for _, _, x in sample], target, params).astype(np.float32)

    def make():
        def f(texts):
            out = []
            for t in texts.to_pylist():
                values = signals(t)
                s, x = features(t, values)
                v = votes(values)
                z = float(weights[s].astype(np.float64) @ x.astype(np.float64) + weights[DIM])
                out.append((v, posterior.get(v, share), 1 / (1 + np.exp(-min(700.0, max(-700.0, z))))))
            v, p, z = zip(*out, strict=True)
            return [pa.array(v, pa.string()), pa.array(p, pa.float64()), pa.array(z, pa.float64()), pa.array([q >= params.cutoff for q in z], pa.bool_())]

        return f

    return add_columns(docs, ["text"], [("votes", "string"), ("posterior", "double"), ("score", "double"), ("kept", "boolean")], make)

"""SentencePiece encoding and decoding over a table of distinct marked words.

In a model whose pieces never hold a white-space marker after another
character, no merge crosses the start of a run of markers. The text then falls
into marked words (markers, then other characters) that can be segmented on
their own. Each worker keeps one table of the distinct marked words it has met;
a word is segmented when it first comes, and the ids of a document are gathered
from the table by the positions of its words. The table belongs to a Python worker,
which keeps it from task to task, not to the cluster: a table for all workers
would need the position lists of every document to be shuffled, which are about
as large as the texts.

A model that breaks the rule (pieces across markers, or a normaliser that
changes characters) is recognised from its vocabulary and by a probe, and whole
texts are then segmented by the library.

Defined results: a null or empty text has no ids and decodes to the empty
string; rows are kept one to one, repeated rows included; extra columns stay,
and a column named like an output is replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, clear_caches

MARK = "▁"
_CHUNK = re.compile(f"[ {MARK}]+[^ {MARK}]*")


class PieceTable:
    """Distinct marked words and their ids, in flat arrays.

    ``max_chars`` bounds the text of the words kept; beyond it the table starts
    anew, which costs time only.
    """

    def __init__(self, model: str, max_chars: int = 3_000_000):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.max_chars = max_chars
        self.by_word = self._by_word()
        self.clear()

    def _by_word(self) -> bool:
        sp = self.sp
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and MARK in sp.id_to_piece(i).lstrip(MARK):
                return False
        probe = "a" + "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x20000)])) + "  a "
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            return False
        # a word that is a marker only, as the library ends "a " with it
        two, one = sp.encode("a "), sp.encode("a")
        self.alone = two[len(one) :]
        return two[: len(one)] == one

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.n_ids = self.n_words = self.chars = 0

    def _add(self, words: list[str]) -> None:
        got = self.sp.encode(words, num_threads=1)
        got = [g if w else self.alone for g, w in zip(got, words, strict=True)]
        lens = np.fromiter(map(len, got), np.int64, len(got))
        total = int(lens.sum())
        while self.n_ids + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n_words + len(words) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.ids[self.n_ids : self.n_ids + total] = np.fromiter((x for g in got for x in g), np.int32, total)
        self.start[self.n_words + 1 : self.n_words + len(words) + 1] = self.n_ids + np.cumsum(lens)
        self.n_ids += total
        self.n_words += len(words)
        self.chars += sum(map(len, words))

    @staticmethod
    def words(text: str) -> list[str]:
        """The marked words of a text, each without its first marker."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " ":
            return [c[1:] for c in _CHUNK.findall(" " + text)]
        return text.split(" ")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts, and offsets of each text's ids."""
        if not self.by_word:
            got = self.sp.encode([t or "" for t in texts], num_threads=1)
            lens = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter((x for g in got for x in g), np.int32, int(lens.sum()))
            return flat, np.concatenate([[0], np.cumsum(lens)])
        if self.chars > self.max_chars:
            self.clear()
        index, new = self.index, []
        codes: list[int] = []
        counts = []
        for t in texts:
            words = self.words(t or "")
            counts.append(len(words))
            at = list(map(index.get, words))
            if None in at:
                for k, w in enumerate(words):
                    if at[k] is None:
                        if (c := index.get(w)) is None:
                            c = index[w] = self.n_words + len(new)
                            new.append(w)
                        at[k] = c
            codes += at
        if new:
            self._add(new)
        at = np.array(codes, np.int64)
        first = self.start[at]
        lens = self.start[at + 1] - first
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.arange(total) + np.repeat(first - (ends - lens), lens)]
        upto = np.concatenate([[0], ends])
        return flat, upto[np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])]

    def decode(self, flat: np.ndarray, offsets: np.ndarray) -> list[str]:
        ids = flat.tolist()
        lists = [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return self.sp.decode(lists, num_threads=1) if lists else []


_TABLES: dict[str, PieceTable] = {}


def _table(model: str) -> PieceTable:
    clear_caches()  # the table takes a worker's memory alone
    if model not in _TABLES:
        _TABLES[model] = PieceTable(model)
    return _TABLES[model]


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids (array<int>) of every text; no begin or end ids."""

    def make():
        pieces = _table(model)

        def f(texts):
            flat, offsets = pieces.encode(texts.to_pylist())
            return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))]

        return f

    return add_columns(df, [text], [(ids, "array<int>")], make)


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text the library gives back for ids; null ids count as none."""

    def make():
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)

        def f(lists):
            return [pa.array(sp.decode([x or [] for x in lists.to_pylist()], num_threads=1), pa.string())]

        return f

    return add_columns(df, [ids], [(text, "string")], make)


def encode_decode(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``decode(encode(df))`` in one pass: adds ``ids`` and ``decoded``."""

    def make():
        pieces = _table(model)

        def f(texts):
            flat, offsets = pieces.encode(texts.to_pylist())
            back = pieces.decode(flat, offsets)
            return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)), pa.array(back, pa.string())]

        return f

    return add_columns(df, [text], [("ids", "array<int>"), ("decoded", "string")], make)


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of an encoded frame."""
    return encoded.select(
        *[c for c in encoded.columns if c not in ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def model_path() -> str:
    """The public tokenizer's file, as its package names it."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")

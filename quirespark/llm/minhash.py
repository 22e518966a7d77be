"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles, as 64-bit hashes. One pass
over the texts gives each document's set size, a 128-bit digest of its set, the
keys of its bands (``rows`` minima each) and a signature of BITS low bits of its
minima, packed into longs.

Documents with one digest are one class, of which the smallest id takes part in
the search. Candidates come from the bands: in every bucket all members are
compared with one centre, the linked ones are contracted to components, and the
buckets that still hold several components get other centres; what is left
is compared across components, each pair that shares a bucket, whatever the
bucket's size; those of over SMALL members are cut into cells for that. So a group of linked
copies costs a number of comparisons in proportion to its size, and the
members of other components in its buckets one with each of them. A pair is dropped without a look at its
sets where its signatures agree in so few bits that the collision-corrected
estimate lies SLACK standard errors below the threshold; the others are confirmed by the exact
size of the intersection of the full sets. In the later rounds sets of up to FEW
shingles stand beside the signatures, so that only true links become pairs.

With similarity s a pair shares a band with probability
1 - (1 - s^rows)^bands: 1 - 3e-6 at 0.85 for CONTRACT, 1 - 5e-6 at 0.8 for
PRODUCTION. Many rows keep documents apart that share a passage only.

Defined results: null and empty texts have no shingles and link with nothing;
with fewer words than a shingle the whole sequence is the one shingle; rows
without an id are linked to no other text and are kept, unless their text also
has an id; rows that share an id are one document for the links, and all of
them are returned. Extra columns are left out of ``link`` and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, cache, checkpoint, fresh, prefilter, release, ship, unplaced
from .graph import bucket_components, shared_buckets

BITS = 2
SIGNATURE = 512  # minima in a signature
SLACK = 4.5  # standard errors of the estimate, beyond which a pair is dropped
FEW = 512  # shingles of a set that later rounds carry with its signature
SMALL = 1000  # members of a bucket above which it is cut into cells of as many against as many

_WORDS_KEPT = 1 << 18  # hashed words a worker remembers


@dataclass(frozen=True)
class Near:
    """Shingles of ``words`` words; linked where den * both >= num * either."""

    words: int = 5
    num: int = 80
    den: int = 100
    bands: int = 40
    rows: int = 6


PRODUCTION = Near()
CONTRACT = Near(words=3, num=85, rows=8)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = cache(_Words())


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes; A-Z count as a-z, words end at ASCII white space."""
    if not text:
        return np.zeros(0, np.uint64)
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(tokens))
    n = len(h) - size + 1
    out = np.full(n, size if size < words else 0, np.uint64)
    for i in range(size):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


#: Multipliers of the hash functions; odd, so that each permutes 32-bit numbers.
_A = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 32, size=1024, dtype=np.uint32) | np.uint32(1)


def minima(shingles: np.ndarray, k: int) -> np.ndarray:
    """The minima of the first k hash functions over a set that isn't empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(k, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        out = np.minimum(out, (_A[:k, None] * x[None, i : i + 2048]).min(axis=1))
    return out.astype(np.uint64)


def features(text: str | None, near: Near) -> tuple[int, int, int, list[int], list[int]]:
    """Set size, two halves of the digest, band keys, packed signature."""
    s = shingle_set(text, near.words)
    if not len(s):
        return 0, 0, 0, [], []
    import xxhash

    digest = xxhash.xxh3_128_intdigest(s.tobytes())
    m = _mixed(minima(s, max(SIGNATURE, near.bands * near.rows)))
    keys = np.arange(near.bands, dtype=np.uint64)
    for i in range(near.rows):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + m[i : near.bands * near.rows : near.rows])
    low = m[:SIGNATURE] & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    shifts = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
    packed = np.bitwise_or.reduce(low.reshape(-1, per) << shifts, axis=1)
    halves = np.array([digest & 0xFFFFFFFFFFFFFFFF, digest >> 64], np.uint64).view(np.int64)
    return len(s), int(halves[0]), int(halves[1]), keys.view(np.int64).tolist(), packed.view(np.int64).tolist()


def add_features(docs: DataFrame, near: Near) -> DataFrame:
    def make():
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

        def f(texts):
            rows = list(zip(*(features(t, near) for t in texts.to_pylist()), strict=True))
            return [pa.array(c, kind) for c, kind in zip(rows, kinds, strict=True)]

        return f

    new = [("n_shingles", "long"), ("d1", "long"), ("d2", "long"), ("bands", "array<long>"), ("sig", "array<long>")]
    return add_columns(docs, ["text"], new, make)


def _sets(docs: DataFrame, ids: DataFrame, near: Near) -> DataFrame:
    """(id, shingles as bytes, few) of the documents in ``ids``.

    ``few`` holds the low halves of the hashes of a set of up to FEW shingles, if
    they differ from each other; it is null for all other sets. Most other
    documents are dropped where they are read, so that the join moves sets of
    few documents and not all texts.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                sets = [shingle_set(t, near.words) for t in part.column(1).to_pylist()]
                low = [s.astype(np.uint32).view(np.int32) if len(s) <= FEW else None for s in sets]
                low = [None if x is None or len(np.unique(x)) < len(x) else x for x in low]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(low, pa.list_(pa.int32()))], names=["id", "shingles", "few"])

    some = prefilter(docs.filter("id IS NOT NULL"), "id", ids).select("id", "text")
    return some.mapInArrow(run, "id long, shingles binary, few array<int>").join(ids, "id", "left_semi")


def agreement(x: str, y: str) -> Column:
    """Estimated similarity from two packed signatures, corrected for collisions.

    Of BITS random bits a share of 2^-BITS agrees by chance. A slot agrees when
    all its bits do: the differing bits are folded onto the lowest and counted.
    """
    mask = sum(1 << (BITS * i) for i in range(64 // BITS))
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask
    differ = F.lit(0)
    for i in range(SIGNATURE * BITS // 64):
        d = F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))
        folded = d
        for j in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(d, j))
        differ = differ + F.bit_count(folded.bitwiseAND(F.lit(mask).cast("long")))
    same = F.lit(1.0) - differ.cast("double") / F.lit(float(SIGNATURE))
    chance = 2.0**-BITS
    return (same - F.lit(chance)) / F.lit(1 - chance)


def least_agreement(near: Near) -> float:
    """The estimate that a linked pair falls below with probability 3e-6 at most."""
    chance, s = 2.0**-BITS, near.num / near.den
    p = s + (1 - s) * chance
    return s - SLACK * (p * (1 - p) / SIGNATURE) ** 0.5 / (1 - chance)


def _may_link(near: Near, x: str, y: str) -> Column:
    """Whether the pair may be linked, by the sizes and signatures of both sides."""
    a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    # the smaller set bounds the intersection, the larger the union
    return (F.least(a, b) * near.den >= F.greatest(a, b) * near.num) & (agreement(f"{x}.sig", f"{y}.sig") >= least_agreement(near))


def _close(near: Near, x: str, y: str) -> tuple[Column, Column]:
    """``_may_link``, and whether enough shingles are shared, for sets of up to FEW."""
    a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    both = F.size(F.array_intersect(f"{x}.few", f"{y}.few"))
    enough = both * (near.den + near.num) >= (a + b) * near.num
    return _may_link(near, x, y), F.when(F.col(f"{x}.few").isNull() | F.col(f"{y}.few").isNull(), True).otherwise(enough)


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """Those of the pairs (a, b) that are linked, on their full sets."""
    light = reps.select("id", "n_shingles", "sig")
    p = pairs.join(light.select(F.col("id").alias("a"), F.struct("n_shingles", "sig").alias("x")), "a")
    p = p.join(light.select(F.col("id").alias("b"), F.struct("n_shingles", "sig").alias("y")), "b")
    p = checkpoint(p.filter(_may_link(near, "x", "y")).select("a", "b"))
    ids = p.select(F.col("a").alias("id")).unionByName(p.select(F.col("b").alias("id"))).distinct()
    sets = checkpoint(_sets(docs, checkpoint(ids), near).drop("few"))
    full = p.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    full = full.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(near.den * both >= near.num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))

    return full.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def link(docs: DataFrame, near: Near = PRODUCTION) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    all_rows = checkpoint(add_features(docs.select(F.col("doc_id"), "text"), near).drop("text"))
    classes = all_rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(F.min("doc_id").alias("id"))
    classes = checkpoint(classes)
    first = classes.select(F.col("id").alias("__id"), F.col("d1").alias("__d1"), F.col("d2").alias("__d2"))
    same = (F.col("doc_id") == F.col("__id")) & (F.col("d1") == F.col("__d1")) & (F.col("d2") == F.col("__d2"))
    reps = all_rows.join(first, same, "left_semi").dropDuplicates(["doc_id"])
    reps = checkpoint(reps.select(F.col("doc_id").alias("id"), "n_shingles", "bands", "sig"))
    texts = docs.select(F.col("doc_id").alias("id"), "text")

    buckets = shared_buckets(reps.select("id", F.explode("bands").alias("key")))

    def traits(ids: DataFrame) -> DataFrame:
        sets = _sets(texts, ids, near).groupBy("id").agg(F.when(F.count("*") == 1, F.max("few")).alias("few"))
        return checkpoint(reps.select("id", "n_shingles", "sig").join(sets.select(unplaced("id"), "few"), "id"))

    found = bucket_components(buckets, lambda pairs: _verified(pairs, reps, texts, near), traits, lambda x, y: _close(near, x, y), SMALL)
    release(buckets)
    of_class = classes if found is None else classes.join(found, F.col("id") == F.col("node"), "left").withColumn("id", F.coalesce("component", "id"))
    of_class = of_class.select(unplaced("d1"), F.col("d2").alias("e2"), F.col("id").alias("component_id")).withColumnRenamed("d1", "e1")
    out = all_rows.select("doc_id", "n_shingles", "d1", "d2").join(of_class, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & (F.col("n_shingles") > 0), "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def dedup(docs: DataFrame, near: Near = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` that stay: of every group of near-duplicates the smallest id.

    Rows that share the id that stays are told apart no further and all stay;
    rows without an id stay.
    """
    (gone,) = fresh(docs, "__gone")
    drop = link(docs, near).filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(drop, docs["doc_id"] == F.col(gone), "left_anti")


def brute_force(texts: dict[int, str | None], near: Near) -> dict[int, tuple[int, int]]:
    """(set size, component) by comparing all pairs; for tests."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode("utf-8", "surrogatepass").lower().split()
        k = min(near.words, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and near.den * both >= near.num * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


#: For CONTRACT, by counting shared shingles of all pairs.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i : i + 2], ' ') FOR i IN range(1, len(words) - 1)]) END) AS shingle FROM w
), n AS (
  SELECT w.doc_id, count(s.shingle)::BIGINT AS n_shingles FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n_shingles + y.n_shingles - shared)
), r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
)
SELECT n.doc_id, n.n_shingles, min(r.reached) AS component_id, n.doc_id = min(r.reached) AS kept
FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""

__all__ = ["CONTRACT", "PRODUCTION", "Near", "brute_force", "dedup", "link"]

"""Links within very large buckets: each pair that shares a bucket is compared, none by chance."""

import random

import pytest

import corpus_pipeline
from quirespark.llm import graph, line_dedup, minhash


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def far_and_near():
    """A text with 200 near copies, most of them near the threshold and too far from each other for a link."""
    rng = random.Random(23)
    base = words(rng, 150).split()
    texts = {0: " ".join(base)}
    for i in range(1, 201):
        w = list(base)
        for at in rng.sample(range(len(w)), rng.choice([3, 4])):
            w[at] = f"x{rng.randrange(100000)}"
        texts[i] = " ".join(w)
    return texts


@pytest.fixture(scope="module")
def pairs():
    """Variants of one text, most too far from each other for a link, each with a near copy."""
    rng = random.Random(23)
    base = words(rng, 150).split()
    texts = {}
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(len(w)), 5):
            w[at] = f"x{rng.randrange(100000)}"
        v = list(w)
        for at in rng.sample(range(len(w)), 3):
            v[at] = f"y{rng.randrange(100000)}"
        texts[2 * i], texts[2 * i + 1] = " ".join(w), " ".join(v)
    return texts


@pytest.fixture
def large(monkeypatch):
    """Buckets of over 4 members are large, and of one centre in the second round."""
    monkeypatch.setattr(graph, "CENTRES", 1)
    monkeypatch.setattr(minhash, "SMALL", 4)
    monkeypatch.setattr(line_dedup, "SMALL", 4)


def test_near_duplicates_in_large_buckets(spark, large, far_and_near):
    df = spark.createDataFrame(list(far_and_near.items()), "doc_id long, text string")
    want = minhash.brute_force(far_and_near, minhash.CONTRACT)
    assert [c for _, c in want.values()].count(0) > 60
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.link(df, minhash.CONTRACT).collect()}
    assert got == want


def first_lines(texts):
    """Ids of the texts that are no later near copies, by all pairs of sets of characters."""
    n = line_dedup.WINDOW
    sets, root = {i: {t[j : j + n] for j in range(len(t) - n + 1)} for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= line_dedup.NUM * len(sets[i] | sets[j]):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i for i in texts if find(i) == i}


def test_lines_in_large_buckets(spark, large, pairs):
    df = spark.createDataFrame(list(pairs.items()), "doc_id long, text string")
    stay = first_lines(pairs)
    assert 60 < len(stay) < 200
    assert {r.doc_id for r in line_dedup.decisions(df).filter("n_removed = 0").collect()} == stay


def test_stages_of_the_pipeline_in_large_buckets(spark, large, pairs):
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in pairs.items()], "doc_id long, text string, lang string, source string, n_chars long")
    groups = minhash.brute_force(pairs, minhash.PRODUCTION)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == {i for i, (_, c) in groups.items() if i == c}
    assert {r.doc_id for r in corpus_pipeline.lines(spark, df, "").filter("text <> ''").collect()} == first_lines(pairs)

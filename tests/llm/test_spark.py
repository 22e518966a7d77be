"""Operators on small tables: odd rows, hot groups, brute force, SQL."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quirespark.llm import chat, graph, html_extract, line_dedup, media, minhash, mixing, pieces, prefix, quality_model, quality_rules, registry, secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(5000))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, white space only."""
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, LONG, "b"), (5, LONG, "b"), (5, LONG, "b"), (6, "one", None), (None, "no id here", "a"), (7, "one", "c")]
    return docs(spark, rows).withColumn("ids", F.lit("clash")).withColumn("bands", F.lit(1)).withColumn("media", F.lit("m"))


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho", "sigma", "tau", "phi", "chi", "psi"]) + str(rng.randrange(50)) for _ in range(n))


def test_components_match_brute_force(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in root}


def test_running_sums_of_a_hot_group(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1900, 1).otherwise(F.col("id")).cast("long").alias("g"), "id", F.lit(1).cast("long").alias("v"))
    got = prefix.before(df, "g", [F.col("id")], "v", "at").filter("g = 1").select("id", "at").collect()
    assert {r.id: r["at"] for r in got} == {i: i for i in range(1900)}


@pytest.mark.parametrize("n", [2, 4, 6, 9])
def test_odd_rows_by_row_operators(spark, odd, none, tmp_path, n):
    labels = spark.createDataFrame([(1, 1, 0), (99, None, None)], "doc_id long, quality int, toxic int")
    f = {
        2: media.media_digest,
        4: lambda d: pieces.digests(pieces.encode_decode(d, pieces.model_path())),
        6: lambda d: quality_rules.apply_rules(d, labels),
        9: secrets.secret_digest,
    }[n]
    rows = f(odd).collect()
    assert len(rows) == 9
    assert f(none).count() == 0
    by = {r.doc_id: r for r in rows}
    if n == 2:
        assert (by[1].n_bytes, by[1].payload_bytes) == (0, 64)
        assert by[1].media_sha256 == by[2].media_sha256
        assert by[4].media_sha256 == by[5].media_sha256
    elif n == 4:
        assert by[1].n_tokens == by[2].n_tokens == 0
        assert by[4].ids_sha256 == by[5].ids_sha256
    elif n == 6:
        assert by[3].n_words == 0 and by[3].base_failed and not by[3].kept
        assert by[4].n_words == 5000 and by[4].kept


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, "u", "<p>Some text here, really.</p>")], "page_id long, url string, html string")
    assert {r.page_id: (r.text, r.n_chars) for r in html_extract.page_texts(pages).collect()} == {1: ("", 0), 2: ("", 0), 3: ("Some text here, really.", 23)}


def test_chat_collapses_snapshots(spark):
    turns = ["hi", "hello", "how are you", "fine"]
    rows = [(c, i, "user", turns[i]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 3)) for i in range(n)]
    rows += [(5, 0, "user", "hi"), (5, 1, "user", "else"), (6, 0, None, None), (2, 0, "user", "hi"), (7, None, "user", "late <|im_end|>"), (7, 0, "user", "early"), (None, 0, "user", "lost")]
    rows += [(8, i, "user", f"turn {i}") for i in range(1200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash"))
    got = chat.chat_format(df).collect()
    assert sorted((r.conv_id or 0, r.part, r.n_turns, r.n_logs) for r in got) == [(0, 0, 1, 1), (2, 0, 4, 2), (5, 0, 2, 1), (6, 0, 1, 1), (7, 0, 2, 1), (8, 0, 1200, 1), (8, 1, 1200, 1), (8, 2, 1200, 1)]
    text = {(r.conv_id, r.part): r.text for r in got}
    assert text[7, 0].count("<|im_end|>") == 2
    assert text[7, 0].index("early") < text[7, 0].index("late")
    assert text[2, 0] == "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in turns)
    assert chat.chat_format(df.filter("false")).count() == 0


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(7)
    texts, base = {}, words(rng, 120).split()
    for i in range(60):  # near copies of one text, some too far apart
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = "x" + str(rng.randrange(1000))
        texts[i] = " ".join(w)
    for i in range(60, 90):
        texts[i] = words(rng, 60)
    texts |= {90: texts[61], 91: "", 92: None, 93: "two words", 94: "TWO  words", 95: " "}
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    want = minhash.brute_force(texts, minhash.CONTRACT)
    got = {r.doc_id: r for r in minhash.link(df, minhash.CONTRACT).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_large_buckets_are_divided_without_loss(spark, monkeypatch):
    """One group of near copies, of which some are linked by chains only and some not at all."""
    monkeypatch.setattr(minhash, "SMALL", 12)
    monkeypatch.setattr(line_dedup, "SMALL", 12)
    rng = random.Random(17)
    base = words(rng, 150).split()
    texts = {}
    for i in range(160):
        w = list(base)
        for _ in range(rng.choice([1, 3, 6, 9, 14])):
            w[rng.randrange(len(w))] = "x" + str(rng.randrange(100000))
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = minhash.brute_force(texts, minhash.CONTRACT)
    assert len(set(c for _, c in want.values())) > 20
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.link(df, minhash.CONTRACT).collect()} == want
    sets = {i: {t[j : j + line_dedup.WINDOW] for j in range(len(t) - line_dedup.WINDOW + 1)} for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in texts:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    assert {r.doc_id: r.n_removed for r in line_dedup.decisions(df).collect()} == {i: int(find(i) != i) for i in texts}


def test_near_duplicates_odd_rows(odd, none):
    got = minhash.dedup(odd).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 3, 4, 6]
    assert minhash.link(none).count() == 0


def _grams(line):
    line = line.strip().lower()
    return {line[i : i + line_dedup.WINDOW] for i in range(len(line) - line_dedup.WINDOW + 1) if not line[i].isspace() and (i == 0 or line[i - 1].isspace())}


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(11)
    base = [words(rng, 30) for _ in range(6)]
    rows = []
    for i in range(40):
        lines = []
        for b in rng.sample(base, 3):
            w = b.split()
            if rng.random() < 0.5:
                w[rng.randrange(30)] = "changed" + str(rng.randrange(99))
            lines.append(" ".join(w))
        rows.append((i, "\n".join([*lines, "short", words(rng, 25)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gone", F.lit("clash"))
    at = [(d, p, x) for d, t in rows for p, x in enumerate(t.split("\n")) if len(x) >= line_dedup.MIN_CHARS]
    root = list(range(len(at)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [_grams(x) for _, _, x in at]
    for i in range(len(at)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    gone = {(d, p) for i, (d, p, _) in enumerate(at) if find(i) != i}
    want = {d: "\n".join(x for p, x in enumerate(t.split("\n")) if (d, p) not in gone) for d, t in rows}
    assert {r.doc_id: r.text for r in line_dedup.dedup(df).collect()} == want
    got = {r.doc_id: (r.n_lines, r.removed) for r in line_dedup.decisions(df).collect()}
    assert got == {d: (t.count("\n") + 1, sorted(p for e, p in gone if e == d)) for d, t in rows}


def test_line_dedup_odd_rows(odd, none):
    got = {(r.doc_id, r.text) for r in line_dedup.dedup(odd).collect()}
    assert {(1, None), (2, ""), (4, LONG), (5, ""), (6, "one"), (7, "one")} <= got
    assert line_dedup.decisions(none).count() == 0


def test_mixing_targets_and_positions(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randrange(1, 60)), rng.choice(["hot", "hot", "hot", "b", "ä", None, "rare" if i < 20 else "b"])) for i in range(400)]
    rows += [(1000, None, "empty"), (1001, "", "empty"), (3, rows[3][1], rows[3][2])]
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(order)
    while open_:  # share, cap, share the excess again
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > 2 * size[s]}
        if not full:
            target |= {s: unit * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= full
    of = {i: s for i, _, s in rows}
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert math.isclose(r.target, target[of[r.doc_id]], abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r["size"]
        assert (r.position is None) == (r.taken == 0)
        taken[of[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) < 1 for s in order)
    at = [r.position for r in got if r.position is not None]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    again = mixing.mix(docs(spark, rows[::-1])).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mixing_follows_the_schedules(spark):
    """Of every source, each tenth of training takes what the integral of its schedule says."""
    rows = [(i, "w " * (5 + i % 7), ("a", "b", "c", "d")[min(3, i * i % 17 // 3)]) for i in range(4000)]
    params = mixing.PRODUCTION
    got = mixing.mix(docs(spark, rows).withColumn("size", F.lit("clash")).withColumn("rank", F.lit(1)), params).collect()
    of = {i: s for i, _, s in rows}
    for k, source in enumerate("abcd"):
        own = [r for r in got if of[r.doc_id] == source]
        whole, s = int(own[0].target), params.schedules[k % 3]
        # what each pass gives, at its position
        given = [(at, r["size"] if len(r.positions) > p + 1 else r.taken - p * r["size"]) for r in own for p, at in enumerate(r.positions)]
        assert sum(w for _, w in given) == whole
        total = (s[0] + 2 * s[1] + s[2]) / 4
        for tenth in range(1, 11):
            t = tenth / 10
            x = min(t, 0.5)
            area = s[0] * x + (s[1] - s[0]) * x * x + (s[1] * (t - x) + (s[2] - s[1]) * (t - x) ** 2)
            assert abs(sum(w for at, w in given if at <= t) / whole - area / total) < 0.02
        if whole == 2 * own[0].source_size:
            assert max(at for at, _ in given) > 0.98


def test_mixing_ties_and_passes(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, "d e f", "s"), (None, "g", None), (3, "x y", "t")]
    df = docs(spark, rows).withColumn("positions", F.lit("clash"))
    got = mixing.passes(df).collect()
    assert {r.positions for r in got} == {"clash"}
    taken = {}
    for r in mixing.mix(df).collect():  # rows of an id are taken as often as the one taken most
        taken[r.doc_id] = max(taken.get(r.doc_id, 0), len(r.positions))
    count = {i: sum(r.doc_id == i for r in got) for i in taken}
    assert count == {i: n * (2 if i == 1 else 1) for i, n in taken.items()}


def test_mixing_empty(none):
    assert mixing.mix(none).count() == 0
    assert mixing.passes(none).count() == 0


def test_rules_bound_false_rejection(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["river", "stone", "light", "cloud"]) + str(rng.randrange(500)) + ("#" if i % 10 == 0 and rng.random() < 0.8 else "") for _ in range(60)), "s") for i in range(3000)]
    labels = spark.createDataFrame([(i, 0 if i % 10 == 0 else 1, 0) for i in range(0, 3000, 2)], "doc_id long, quality int, toxic int")
    got = quality_rules.apply_rules(docs(spark, rows), labels).collect()
    good = [r for r in got if r.doc_id % 10]
    assert sum(not r.kept for r in good) <= 0.05 * len(good)
    assert sum(not r.kept for r in got if r.doc_id % 10 == 0) > 250


def test_classifier_on_held_out_labels(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality_model.classify(d, quality_model.Weak(train_rows=200)).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    assert sum(good) >= 0.95 * len(good)
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.9 * len(rows)


def test_classifier_replaces_columns_of_its_own_names(odd):
    clash = odd.withColumn("votes", F.lit(3)).withColumn("kept", F.lit("k")).withColumn("score", F.lit("s")).withColumn("h", F.lit("h")).withColumn("slots", F.lit(0))
    got = quality_model.classify(clash).collect()
    assert len(got) == 9 and {r.h for r in got} == {"h"}
    assert {type(r.kept) for r in got} == {bool} and {type(r.score) for r in got} == {float}
    by = {}
    for r in got:
        by.setdefault(r.text, set()).add((r.votes, r.score))
    assert all(len(v) == 1 for v in by.values())


def test_classifier_of_a_single_pattern(spark):
    rows = [(i, " ".join(f"The {a}{b} of {b}{a} is in the light." for a, b in zip("bcdfghklmn", "aeioueaeio")), "a") for i in range(5)]
    assert [r.kept for r in quality_model.classify(docs(spark, rows)).collect()] == [True] * 5


def test_chat_renders_very_long_turns(spark):
    long = LONG * 30
    df = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", ""), (2, 0, "user", long)], "conv_id long, turn long, role string, text string")
    got = chat.chat_format(df).collect()
    assert [(r.conv_id, r.n_logs) for r in got] == [(1, 1)]
    assert got[0].text == f"<|im_start|>user\n{long}<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"


def test_classifier_odd_rows(odd, none):
    got = quality_model.classify(odd.drop("ids", "bands", "media")).collect()
    assert len(got) == 9
    assert quality_model.classify(none).count() == 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = registry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = con.sql(registry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in columns]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, (tuple(r[i] for i in at) for r in rel.fetchall())))

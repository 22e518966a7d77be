"""The pipeline's rows against plain versions of its stages."""

import hashlib
import random

import corpus_pipeline
from pyspark.sql import functions as F
from quirespark.llm import line_dedup, minhash, pieces, quality_model


def grams(line):
    line = line.strip().lower()
    return {line[i : i + line_dedup.WINDOW] for i in range(len(line) - line_dedup.WINDOW + 1) if not line[i].isspace() and (i == 0 or line[i - 1].isspace())}


def plain_lines(docs):
    at = [(i, p, x) for i, t in sorted(docs.items()) for p, x in enumerate((t or "").split("\n")) if len(x.strip()) >= line_dedup.MIN_CHARS]
    sets, root = [grams(x) for _, _, x in at], list(range(len(at)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(at)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    gone = {(d, p) for k, (d, p, _) in enumerate(at) if find(k) != k}
    return {d: t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (d, p) not in gone) for d, t in docs.items()}


def plain_mix(docs, source):
    size = {i: len((t or "").split()) for i, t in docs.items()}
    names = sorted({source[i] for i in docs})
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    of = {s: sum(size[i] for i in docs if source[i] == s) for s in names}
    target, left, open_ = {}, 1.5 * sum(of.values()), set(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > 2 * of[s]}
        for s in full or open_:
            target[s] = 2.0 * of[s] if full else unit * weight[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    times = {}
    for s in names:
        start = 0
        for i in sorted((i for i in docs if source[i] == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
            taken = sum(max(0, min(size[i], int(target[s]) - start - p * of[s])) for p in range(2))
            times[i] = -(-taken // size[i]) if size[i] else 0
            start += size[i]
    return times


def test_pipeline_matches_plain_stages(spark, tmp_path):
    rng = random.Random(12)
    stock = ["the", "of", "and", "river", "stone", "light", "cloud", "under", "over", "north", "south", "white", "green"]

    def line(n):
        return " ".join(rng.choice(stock) + (str(rng.randrange(90)) if rng.random() < 0.5 else "") for _ in range(n))

    shared, rows = line(20), []
    for i in range(60):
        rows.append((i, "\n".join(line(15) for _ in range(4)) + ("\n" + shared if i % 7 == 0 else ""), f"s{i % 4}"))
    # one long line that differs by a word here and there
    long = line(300).split()
    for i in range(60, 66):
        w = list(long)
        w[rng.randrange(300)] = "changed"
        rows.append((i, "\n".join(" ".join(w[k : k + 3])[: line_dedup.MIN_CHARS - 1] for k in range(0, 300, 3)), "s1"))
    rows += [(70, None, "s0"), (71, "", "s0"), (72, rows[3][1], "s2")]
    rows += [(80 + i, "!! ".join(line(40).upper().split()) + "!!", "s3") for i in range(8)]
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    source = {i: s for i, _, s in rows}
    kept = {r.doc_id: r.text for r in quality_model.classify(df).filter("kept").collect()}
    assert set(range(66)) <= set(kept)
    docs = plain_lines(kept)
    groups = minhash.brute_force(docs, minhash.PRODUCTION)
    docs = {i: t for i, t in docs.items() if groups[i][1] == i}
    assert not set(range(61, 66)) & set(docs)
    times = plain_mix(docs, source)
    sp = pieces.PieceTable(pieces.model_path()).sp
    want = sorted((i, len(sp.encode(docs[i] or "")), hashlib.sha256(sp.decode(sp.encode(docs[i] or "")).encode()).hexdigest()) for i, n in times.items() for _ in range(n))
    got = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, clashing names; and no rows at all."""
    line = "The river and the stone of the light, and the garden in the morning, number"
    text = lambda k: "\n".join(f"{line} {k} {j}, that is {k * 7 + j} in all, with {j * k} left over for the end." for j in range(5))
    rows = [(None, text(1), None), (1, None, "a"), (2, "", "a"), (3, text(2), "a"), (3, text(2), "a"), (4, text(2), "b"), (5, text(3), "b")]
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumn("position", F.lit(1)).withColumn("votes", F.lit("x")).withColumn("__id", F.lit(2)).withColumn("gone", F.lit(3))
    for k, d in enumerate((df, df.filter("false"))):
        d.write.parquet(str(tmp_path / str(k) / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / str(k))).collect()
        assert {r.doc_id for r in got} <= {None, 1, 2, 3, 4, 5}
        assert k == 0 or got == []
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == df.columns

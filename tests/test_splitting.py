"""Sections, packs and recursive splits against plain versions."""

import random
import re

import pytest

from quirespark.operators import splitting

TOKENS = lambda s: len(s) // 4


def plain_greedy(items, weight, limit):
    groups, held = [], 0
    for x in items:
        if groups and held + weight(x) <= limit:
            groups[-1].append(x)
            held += weight(x)
        else:
            groups.append([x])
            held = weight(x)
    return groups


def plain_paragraphs(text, limit):
    out = []
    for g in plain_greedy([p.strip() for p in re.split(r"\n\s*\n", text) if p.strip()], TOKENS, limit):
        if len(g) == 1 and TOKENS(g[0]) > limit:
            out += [" ".join(x) for x in plain_greedy([s.strip() for s in re.split(r"(?<=[.!?])\s+", g[0]) if s.strip()], TOKENS, limit)]
        else:
            out.append("\n\n".join(g))
    return out


def plain_sections(title, text, limit):
    if TOKENS(text) <= limit:
        return [(title, text, False)]
    lines = text.split("\n")
    heads = []
    for i, line in enumerate(lines):
        s = line.strip()
        listed = sum(bool(re.match(r"\d+\.\d+", lines[j].strip())) for j in range(max(0, i - 3), min(len(lines), i + 4)) if j != i)
        form = any(re.fullmatch(p, s, re.I) for p in splitting.HEADERS)
        if 3 <= len(s) <= 80 and form and (i <= 5 or not lines[i - 1].strip()) and listed < 2:
            heads.append((i, " ".join(re.sub(r"^#+\s*", "", s).rstrip(":.").split())[:80]))
    found = []
    if heads and heads[0][0] > 10 and len(" ".join(lines[: heads[0][0]]).split()) >= 100:
        found.append(("Introduction", "\n".join(lines[: heads[0][0]]).strip()))
    for (i, name), end in zip(heads, [h[0] for h in heads[1:]] + [len(lines)]):
        body = "\n".join(lines[i + 1 : end]).strip()
        if len(body.split()) >= 50:
            found.append((name, body))
    if len(found) < 2:
        found = [(title, text)]
        whole = lambda s: False
    else:
        whole = lambda s: TOKENS(s) <= limit
    out = []
    for name, body in found:
        if whole(body):
            out.append((name, body, False))
        else:
            out += [(f"{name} (Part {k})", p, True) for k, p in enumerate(plain_paragraphs(body, limit), 1)]
    return out


def prose(rng, n):
    out = []
    for _ in range(n):
        out.append(" ".join(rng.choice(["alpha", "Beta", "gamma,", "delta", "rho"]) for _ in range(rng.randint(6, 16))) + ".")
    return " ".join(out)


def chapter(rng):
    parts = []
    for _ in range(rng.randint(1, 14)):
        kind = rng.random()
        head = rng.choice(["## Some Header", "1.2 First steps", "THE LONG ROAD HOME", "Two Words", "Summary:", "3.4 Item\n3.5 Item\n3.6 Item", "no header. at all, really"])
        parts.append((head + ("\n\n" if kind < 0.3 else "\n")) if kind < 0.7 else "")
        parts.append(prose(rng, rng.randint(1, 12)) + rng.choice(["\n\n", "\n", "\n \n", "\u2003\n\n"]))
    return "".join(parts)


def test_sections_match_the_plain_version(spark):
    rng = random.Random(5)
    texts = ["", "short", "\n" * 12 + prose(rng, 40)] + [chapter(rng) for _ in range(60)]
    df = spark.createDataFrame([(i, f"T{i}", t) for i, t in enumerate(texts)] + [(len(texts), None, None)], "id int, title string, text string")
    got = {}
    for r in splitting.sections(df, ["id"], 150).collect():
        got.setdefault(r.id, []).append((r.section_number, r.title, r.content, r.is_partial))
        assert (r.token_count, r.word_count) == (len(r.content) // 4, len(r.content.split()))
    for i, t in enumerate(texts):
        want = plain_sections(f"T{i}", t, 150)
        assert [x[1:] for x in sorted(got.get(i, []))] == want, i
        assert [x[0] for x in sorted(got.get(i, []))] == list(range(1, len(want) + 1))
    assert got[len(texts)] == [(1, "Untitled", "", False)]


def plain_pieces(text, limit, seps, level=0):
    """(piece, kind) by the coarsest separator that divides."""
    if len(text.split()) <= limit:
        return [(text, "word")]
    for k in range(level, len(seps)):
        pattern, kind = seps[k]
        at = sorted({0, *(m.start() for m in re.finditer(pattern, text)), len(text)})
        parts = [text[a:b] for a, b in zip(at, at[1:])]
        if len(parts) > 1:
            return [(t, kind if sub == "word" else sub) for p in parts for t, sub in plain_pieces(p, limit, seps, k + 1)]
    return [(text, "word")]


def plain_chunks(text, limit, overlap, least, seps):
    at, out = 0, []
    for t, kind in plain_pieces(text, limit, seps):
        if t.strip():
            out.append([t, kind, at, at + len(t)])
        at += len(t)
    grown = []
    for k, (t, kind, a, b) in enumerate(out):
        if k and overlap:
            tail = " ".join(out[k - 1][0].split()[-overlap:])
            grown.append([f"{tail} {t}", kind, max(0, a - len(tail) - 1), b])
        else:
            grown.append([t, kind, a, b])
    merged = []
    for t, kind, a, b in grown:
        n = len(t.split())
        if merged and merged[-1][4] < least:
            m = merged[-1]
            merged[-1] = [m[0] + "\n" + t, m[1], m[2], b, m[4] + n]
        else:
            merged.append([t, kind, a, b, n])
    return [tuple(m) for m in merged]


@pytest.mark.parametrize(("limit", "overlap", "least"), [(40, 0, 0), (40, 5, 20), (7, 3, 12)])
def test_recursive_splits_match_the_plain_version(spark, limit, overlap, least):
    rng = random.Random(limit)
    texts = ["", " \n ", "a\x01b \x02a c" * 30, "one two " * 6, "Intro text\nChapter 1\n" + prose(rng, 9) + "\n \nChapter 2\n\n\n" + prose(rng, 12) + "\nPart 2\nend"] + [chapter(rng) for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for f, seps in ((splitting.recursive_split, splitting.SEPARATORS), (lambda d, *a: splitting.recursive_split(d, *a, splitting.CHAPTER_SEPARATORS), splitting.CHAPTER_SEPARATORS)):
        got = {}
        for r in f(df, limit, overlap, least).collect():
            got.setdefault(r.id, []).append((r.chunk_index, r.chunk, r.separator, r.start_index, r.end_index, r.chunk_words))
        for i, t in enumerate(texts):
            assert [x[1:] for x in sorted(got.get(i, []))] == plain_chunks(t, limit, overlap, least, seps), i


def test_validated_splits(spark):
    rows = [(1, n) for n in (5000, 9000, 8000)] + [(2, n) for n in (100, 200, 300, 16000)]
    df = spark.createDataFrame([(i, n, "line") for i, n in rows], "id int, chunk_words int, separator string")
    got = {r.id: r for r in splitting.validate_splits(df, ["id"]).collect()}
    assert (got[1].valid, got[1].quality_score, got[1].issues, got[1].expected_chapters) == (True, 100, [], 2)
    # 4150 on average, three chunks too small and one too large
    assert got[2].issues == ["3 chunks below minimum size", "1 chunks above maximum size"]
    assert (got[2].quality_score, got[2].valid) == (100 - 20 - 15 - 5, False)
    stats = {r.id: r for r in splitting.split_stats(df, ["id"]).collect()}
    assert (stats[2].total_chunks, stats[2].min_chunk_size, stats[2].max_chunk_size, stats[2].separators_used) == (4, 100, 16000, {"line": 4})


def test_chunks_by_characters(spark):
    assert splitting.char_pieces("aaa bbb ccc", 7) == ["aaa bbb", "ccc"]
    assert splitting.char_pieces("one. two\n\nthree four", 9) == ["one. two", "three", "four"]
    assert splitting.char_pieces("abcdefgh", 3) == ["abc", "def", "gh"]
    assert splitting.char_pieces("", 3) == []
    assert splitting.char_pieces("a b c d", 2, length=lambda x: len(x.split())) == ["a b", "c d"]
    rng = random.Random(2)
    texts = [chapter(rng) for _ in range(20)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = splitting.split_chars(df, 80).collect()
    for r in rows:
        assert len(r.chunk) <= 80 and r.word_count == len(r.chunk.split())
        assert texts[r.id][r.start_pos : r.end_pos] == r.chunk
    for i, t in enumerate(texts[:20]):
        assert "".join("".join(r.chunk for r in sorted(rows, key=lambda r: r.chunk_index) if r.id == i).split()).replace(".", "") == "".join(t.split()).replace(".", "")

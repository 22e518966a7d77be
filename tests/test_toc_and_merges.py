"""Quality re-splits, titles of tables of contents and merges against plain versions."""

import random
import re
from statistics import median

from pyspark.sql import functions as F

from quirespark.operators import detection, merging, splitting, toc


def plain_parts(title, text, limit):
    n = len(text.split())
    if n <= limit:
        return [(title, text)]

    def even(w):
        parts = -(-len(w) // limit)
        size = -(-len(w) // parts)
        return [" ".join(w[i : i + size]) for i in range(0, len(w), size)]

    blocks = []
    for p in (p.strip() for p in re.split(r"\n\s*\n", text)):
        if p:
            blocks += [p] if len(p.split()) <= limit else even(p.split())
    packs = []
    for p in blocks:
        if packs and sum(len(x.split()) for x in packs[-1]) + len(p.split()) <= limit:
            packs[-1].append(p)
        else:
            packs.append([p])
    return [(title if k == 0 else f"{title} (part {k + 1})", "\n\n".join(g)) for k, g in enumerate(packs)]


def plain_quality(chapters, fewest, most, ratio):
    def apply(limit_of):
        return [part for i, (t, x) in enumerate(chapters) for part in (plain_parts(t, x, limit_of[i]) if i in limit_of else [(t, x)])]

    size = lambda x: len(x[1].split())
    for _ in range(3):
        before = list(chapters)
        chapters = apply({i: most for i, c in enumerate(chapters) if size(c) > most})
        count, chosen = len(chapters), {}
        for i in sorted(range(len(chapters)), key=lambda i: -size(chapters[i])):
            if count < fewest and size(chapters[i]) > most // 2:
                chosen[i] = most // 2
                count += max(2, size(chapters[i]) // (most // 2)) - 1
        chapters = apply(chosen)
        sizes = [size(c) for c in chapters if size(c)]
        if len(chapters) > 1 and sizes:
            m = median(sizes)
            chapters = apply({i: max(500, int(2 * m)) for i, c in enumerate(chapters) if size(c) > ratio * m})
        if chapters == before:
            break
    roots = [re.sub(r"( \(part \d+\))+$", "", t) for t, _ in chapters]
    series = {r for r, (t, _) in zip(roots, chapters) if r != t}
    out, seen = [], {}
    for r, (_, x) in zip(roots, chapters):
        seen[r] = seen.get(r, 0) + 1
        out.append((r if r not in series or seen[r] == 1 else f"{r} (part {seen[r]})", x))
    return out


def test_quality_resplit_matches_the_plain_version(spark):
    rng = random.Random(9)

    def text(n):
        w = [f"w{i}" for i in range(n)]
        out = []
        while w:
            k = rng.choice([40, 300, 900, 5000])
            out.append(" ".join(w[:k]))
            w = w[k:]
        return "\n\n".join(out)

    books = {b: [(rng.choice(["A", "B", "C (part 2)"]), text(rng.choice([0, 30, 200, 700, 1500, 4000]))) for _ in range(rng.randint(1, 9))] for b in range(12)}
    rows = [(b, i + 1, t, x) for b, c in books.items() for i, (t, x) in enumerate(c)]
    df = spark.createDataFrame(rows, "book_id int, chapter_number int, title string, content string")
    got = {}
    for r in splitting.quality_resplit(df, fewest=5, most=1200, ratio=3.0).collect():
        assert r.word_count == len(r.content.split())
        got.setdefault(r.book_id, []).append((r.chapter_number, r.title, r.content))
    for b, c in books.items():
        want = plain_quality(c, 5, 1200, 3.0)
        assert [x[1:] for x in sorted(got[b])] == want, b
        assert [x[0] for x in sorted(got[b])] == list(range(1, len(want) + 1))


def test_words_without_paragraphs_split_evenly(spark):
    df = spark.createDataFrame([(1, 1, "T", " ".join(f"word{i}" for i in range(21)))], "book_id int, chapter_number int, title string, content string")
    assert [r.word_count for r in splitting.resplit(df, 10, "content").orderBy("part").collect()] == [7, 7, 7]


def test_titles_of_tables_of_contents(spark):
    books = {
        1: "Chapter 1: The Road. . . . 3\nChapter 2: The River . . 9\nChapter 3: \"Quoted\" . . . 5\nChapter 4: The Sea... 12",
        2: "x\nChapter 1, First steps, more\nchapter 2, Second steps, more\nChapter 3, Third steps",
        3: "1. Alpha. . . 1\n2. Beta . . 2",
        4: "1\nCommon Conventions and API Elements 1\n2\nTechnical requirements of all of it\n2\nPre-Model Workflow and Preprocessing 17\n3\nDimensionality Reduction Techniques\n5\nSome Other Title Without Its Chain",
        5: "CHAPTER 1\nWhat Is Architecture?  1\nchapter 2\nModules and More 20\nChapter 3\nComponents at Large 44",
        6: "1\nI\nFiles\n2\nI\nStrings 9\n3\nI\nImproving it all",
        7: "nothing\nhere",
    }
    df = spark.createDataFrame(list(books.items()), "book_id int, text string").select("book_id", F.posexplode(F.split("text", "\n")).alias("line_index", "line"))
    got = {r.book_id: r.titles for r in toc.titles(df).collect()}
    assert got == {
        1: ["The Road", "The River", "The Sea"],
        2: ["First steps", "Second steps", "Third steps"],
        4: ["Common Conventions and API Elements", "Pre-Model Workflow and Preprocessing", "Dimensionality Reduction Techniques"],
        5: ["What Is Architecture?", "Modules and More", "Components at Large"],
        6: ["Files", "Strings", "Improving it all"],
    }


def test_candidates_take_titles_once_and_in_order(spark):
    rows = [(1, 10, "The Road", 2), (1, 1001, "Chapter 1: The Road", 3), (1, 1100, "The Road", 2), (1, 1200, "river", 1), (1, 1300, "Else", 1)]
    c = spark.createDataFrame(rows, "book_id int, line_index int, title string, match_type int")
    t = spark.createDataFrame([(1, ["The Road", "A River"])], "book_id int, titles array<string>")
    assert sorted((r.line_index, r.match_type) for r in toc.match_titles(c, t).collect()) == [(10, 2), (1001, 4), (1100, 2), (1200, 4), (1300, 1)]
    assert sorted((r.line_index, r.match_type) for r in toc.match_titles(c, t, external=True).collect())[0] == (10, 4)
    numbered = spark.createDataFrame([(1, 20, "the road", 2), (1, 30, "New", 2)], "book_id int, line_index int, title string, match_type int")
    assert sorted(r.line_index for r in toc.with_numbered(c, numbered).collect()) == [20, 30, 1001, 1100, 1200, 1300]


def plain_merges(chapters, most):
    """Positions of the pairs taken; ``chapters`` has (title, words)."""

    def number(t):
        m = re.match(r"(?i)chapter\s+(\d+)|(\d+)\.\s+|(\d+)\s+[a-z]", t)
        return int(next(g for g in m.groups() if g)) if m else None

    scored = []
    for i, ((t, a), (u, b)) in enumerate(zip(chapters, chapters[1:])):
        if a + b > 25000:
            continue
        x, y = number(t), number(u)
        points = [0.3 * (a < 2000), 0.3 * (b < 2000), 0.25 * bool(re.match(r"Section\s+\d+$|Summary$", u)), 0.2 * bool(x and y and y != x + 1), 0.1 * (3000 <= a + b <= 15000)]
        if any(points) and round(min(1, sum(points)), 6) >= 0.3:
            scored.append((-round(min(1, sum(points)), 6), i))
    scored.sort()
    mean = sum(w for _, w in chapters) / len(chapters)
    if most is None:
        most = max(1, min(int((8000 - mean) / 2000 * len(chapters) / 2), len(scored))) if mean < 8000 else len(scored)
    taken = []
    for _, i in scored[:most]:
        if all(abs(i - j) > 1 for j in taken):
            taken.append(i)
    return sorted(taken)


def test_merges_match_the_plain_version(spark):
    rng = random.Random(3)
    books = {}
    for b in range(30):
        books[b] = [(rng.choice(["Chapter 1: A", "Chapter 2: B", "Section 4", "Summary", "A Plain Title"]), rng.choice([100, 1500, 2500, 4000, 9000, 16000])) for _ in range(rng.randint(1, 12))]
    rows = [(b, 2 * i + 1, t, w, f"text {i} ") for b, c in books.items() for i, (t, w) in enumerate(c)]
    df = spark.createDataFrame(rows, "book_id int, chapter_number int, title string, word_count int, content string")
    for most in (None, 2):
        pairs, merged = {}, {}
        for r in merging.chosen_merges(df, most).collect():
            pairs.setdefault(r.book_id, []).append(r.first)
        for r in merging.merge_chapters(df, most).collect():
            merged.setdefault(r.book_id, []).append(r)
        for b, c in books.items():
            want = plain_merges(c, most)
            assert sorted(pairs.get(b, [])) == want, b
            rows = sorted(merged[b], key=lambda r: r.chapter_number)
            assert [r.chapter_number for r in rows] == list(range(1, len(c) - len(want) + 1))
            assert sum(r.word_count for r in rows) == sum(w for _, w in c)
            firsts = [i for i in range(len(c)) if i - 1 not in want]
            for r, i in zip(rows, firsts, strict=True):
                if i in want:
                    assert r.content == f"text {i}\n\n---\n\ntext {i + 1}"
                    assert r.merged_from == [c[i][0], c[i + 1][0]]
                    assert r.title == (c[i][0] if c[i][0] not in ("Section 4", "Summary") else f"{c[i][0]} + {c[i + 1][0]}")
                else:
                    assert (r.content, r.title, r.merged_from) == (f"text {i} ", c[i][0], None)
    s = {r.book_id: r for r in merging.merge_summary(df, merging.merge_chapters(df)).collect()}
    assert all(s[b].original_count == len(c) and s[b].merges_performed == len(plain_merges(c, None)) for b, c in books.items())


def test_degenerate_results_fall_back(spark):
    ch = spark.createDataFrame([(1, 50), (1, 60), (1, 300), (2, 50), (2, 5000), (3, 10)], "book_id int, word_count int")
    sizes = spark.createDataFrame([(1, 1000), (2, 6000), (3, 9000)], "book_id int, words int")
    assert {r.book_id: r.degenerate for r in detection.degenerate(ch, sizes).collect()} == {1: True, 2: False, 3: False}

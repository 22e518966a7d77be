"""Pages whose article is known, and media files written by hand."""

import random
import struct
import time

import pytest

from quirespark.llm import html_extract, media

WORDS = "river stone light cloud under over north south white green because although morning evening garden window".split()


def sentence(rng, n):
    return ", ".join(" ".join(rng.choices(WORDS, k=6)) for _ in range(n)).capitalize() + "."


def links(rng, n):
    return "".join(f'<li><a href="/{i}">{rng.choice(WORDS)} {rng.choice(WORDS)}</a></li>' for i in range(n))


@pytest.mark.parametrize("seed", range(40))
def test_the_article_is_kept_and_nothing_else(seed):
    """Articles in several kinds of containers, between several kinds of boilerplate."""
    rng = random.Random(seed)
    parts, want = [], []
    title = " ".join(rng.choices(WORDS, k=5))
    for _ in range(rng.randint(4, 12)):
        s = [sentence(rng, rng.randint(2, 5)) for _ in range(rng.randint(1, 3))]
        kind = rng.random()
        if kind < 0.7:
            inline = s[0].split(" ", 1)
            parts.append(f"<p>{inline[0]} <em>{inline[1]}</em>\n  " + " ".join(s[1:]) + "</p>")
            want.append(" ".join(s))
        elif kind < 0.85:
            parts.append(f"<h2>{s[0]}</h2>")
            want.append(s[0])
        else:
            parts.append("<ul>" + "".join(f"<li>{x}</li>" for x in s) + "</ul>")
            want += s
    body = "\n".join(parts)
    open_, close = rng.choice([
        ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"), ('<div id="content"><div class="text">', "</div></div>"),
        ('<div class="widget-content">', "</div>"), ('<section class="entry">', "</section>"), ('<div id="related-work">', "</div>"),
    ])
    before = rng.sample([
        f"<nav><ul>{links(rng, 8)}</ul></nav>", f"<header><p>{sentence(rng, 2)}</p></header>", f'<div class="menu"><ul>{links(rng, 6)}</ul></div>', f'<div class="ad"><p>{sentence(rng, 1)}</p></div>',
        "<script>var x = '<p>no</p>';</script>", f'<div role="navigation">{links(rng, 5)}</div>', f'<div class="cookie-notice"><p>{sentence(rng, 1)}</p></div>', "<style>p { color: red }</style>",
    ], 4)
    after = rng.sample([
        f"<footer><p>{sentence(rng, 2)}</p></footer>", f'<aside class="sidebar"><p>{sentence(rng, 2)}</p></aside>', f'<div class="comments"><p>{sentence(rng, 3)}</p><p>{sentence(rng, 3)}</p></div>',
        f'<div class="related"><ul>{links(rng, 7)}</ul></div>', f'<form><label>{sentence(rng, 1)}</label><input type="text"></form>', f'<div id="disqus"><p>{sentence(rng, 4)}</p></div>',
    ], 3)
    page = f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{''.join(before)}{open_}{body}{close}{''.join(after)}</body></html>"
    assert html_extract.extract(page) == " ".join(want)


def test_references_and_white_space():
    page = "<body><article><p>Fish &amp; chips&nbsp;cost &#163;5 &lt;today&gt;,\n\t and   more, of the same.</p><p>A second paragraph of some length, with words, follows.</p></article></body>"
    assert html_extract.extract(page) == "Fish & chips cost £5 <today>, and more, of the same. A second paragraph of some length, with words, follows."


def test_deep_and_long_pages_take_linear_time():
    began = time.perf_counter()
    deep = "<div>" * 2000 + "<p>" + "word, " * 30 + "</p>" + "</div>" * 2000
    assert html_extract.extract(deep) == ("word, " * 30).strip()
    lists = "<body><article><p>" + "text, " * 40 + "</p></article>" + f"<ul>{'<li><a>x y</a></li>' * 3}</ul>" * 3000 + "</body>"
    assert html_extract.extract(lists) == ("text, " * 40).strip()
    long = "<article>" + "<p>some words, and others, in a paragraph.</p>" * 20000 + "</article>"
    assert len(html_extract.extract(long)) == 20000 * 40 - 1
    assert time.perf_counter() - began < 10


def test_html_odd_rows(spark):
    schema = "page_id long, url string, html string, text int"
    rows = [(1, "u", "<p>Some text here, really.</p>", 7), (1, "u", "<p>Some text here, really.</p>", 8), (None, None, None, None), (2, "v", "no markup at all", 1)]
    df = spark.createDataFrame(rows, schema)
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html_extract.page_texts(df).collect()) == [(0, "", 0), (1, "Some text here, really.", 23), (1, "Some text here, really.", 23), (2, "no markup at all", 16)]
    assert html_extract.page_texts(df.filter("false")).count() == 0


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def full(kind, flags, *parts):
    return box(kind, struct.pack(">I", flags), *parts)


def track(number, handler, codec, stbl=b"", duration=0):
    tkhd = full(b"tkhd", 7, struct.pack(">III", 0, 0, number), b"\0" * 68)
    mdhd = full(b"mdhd", 0, struct.pack(">IIIIHH", 0, 0, 1000, duration, 0, 0))
    hdlr = full(b"hdlr", 0, struct.pack(">I4s12x", 0, handler), b"\0")
    stsd = full(b"stsd", 0, struct.pack(">I", 1), box(codec, b"\0" * 8))
    return box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, box(b"minf", box(b"stbl", stsd, stbl))))


def test_fragments_are_decoded():
    trex = full(b"trex", 0, struct.pack(">5I", 1, 1, 40, 0, 0x10000))
    moov = box(b"moov", track(1, b"vide", b"avc1"), box(b"mvex", trex))
    sizes = [5, 7, 3]

    def moof(offset):
        tfhd = full(b"tfhd", 0x20000, struct.pack(">I", 1))
        # data offset, flags of the first sample, sizes
        trun = full(b"trun", 0x1 | 0x4 | 0x200, struct.pack(">Iii", 3, offset, 0), struct.pack(">3I", *sizes))
        return box(b"moof", full(b"mfhd", 0, struct.pack(">I", 1)), box(b"traf", tfhd, trun))

    fragment = moof(len(moof(0)) + 8)
    data = moov + fragment + box(b"mdat", b"ABCDEabcdefgxyz")
    codec, seconds, n, keys, error = media.probe_bytes(data)
    assert (codec, seconds, n, error) == ("avc1", 0.12, 3, None)
    assert [data[a : a + k] for a, k in keys] == [b"ABCDE"]
    assert media.payload(data) == b"ABCDEabcdefgxyz"
    assert media.probe_bytes(data[:-1])[4]


def test_the_video_track_comes_first():
    stbl = lambda at: full(b"stsz", 0, struct.pack(">II", 4, 1)) + full(b"stsc", 0, struct.pack(">4I", 1, 1, 1, 1)) + full(b"stco", 0, struct.pack(">II", 1, at))
    data = box(b"mdat", b"soundpict") + box(b"moov", track(1, b"soun", b"mp4a", stbl(8), 9), track(2, b"vide", b"hev1", stbl(13), 500))
    assert media.probe_bytes(data) == ("hev1", 0.5, 1, [(13, 4)], None)


@pytest.mark.parametrize("stbl", [
    full(b"stsz", 0, struct.pack(">II", 1 << 20, 500_000_000)),
    full(b"stsz", 0, struct.pack(">II", 0, 500_000_000)),
    full(b"stsz", 0, struct.pack(">II", 1, 1)) + full(b"stsc", 0, struct.pack(">4I", 1, 0, 1, 1)) + full(b"stco", 0, struct.pack(">II", 1, 8)),
])
def test_hostile_tables_give_an_error(stbl):
    assert media.probe_bytes(box(b"moov", track(1, b"vide", b"avc1", stbl)))[4]

"""EPUB files: container, manifest, spine and table of contents, by the standard library.

One pass over the bytes of each file gives its spine with texts and its table of
contents; everything after that is DataFrame work.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import should_skip_title

_ENTRY = "struct<title:string,href:string,anchor:string,depth:int>"
_ITEM = "struct<spine_index:int,href:string,text:string>"
SCHEMA = f"path string, source_hash string, title string, author string, language string, spine array<{_ITEM}>, toc array<{_ENTRY}>, error string"


#: Bytes of an item, unpacked, beyond which a file is an error.
MAX_ITEM = 256 << 20


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _first(root, name: str) -> str | None:
    return next((e.text.strip() for e in root.iter() if _local(e.tag) == name and e.text and e.text.strip()), None)


def _resolve(base: str, href: str) -> str:
    out: list[str] = []
    for p in f"{base}/{href}".split("/"):
        if p == "..":
            del out[-1:]
        elif p not in ("", "."):
            out.append(p)
    return "/".join(out)


def plain_text(html: str) -> str:
    """Lines of text of an XHTML page, stripped, without scripts and styles."""
    from html import unescape

    html = re.sub(r"(?is)<(script|style|head)\b.*?</\1>", "", html)
    html = re.sub(r"(?i)</?(p|div|h[1-6]|li|tr|br|section|blockquote|ul|ol|table)\b[^>]*>", "\n", html)
    lines = (re.sub(r"\s+", " ", unescape(x)).strip() for x in re.sub(r"<[^>]+>", "", html).split("\n"))
    return "\n".join(x for x in lines if x)


def _nav_points(node, base: str, depth: int, out: list) -> None:
    for p in node:
        if _local(p.tag) != "navPoint":
            continue
        label = next((t.text or "" for t in p.iter() if _local(t.tag) == "text"), "").strip()
        src = next((c.get("src", "") for c in p if _local(c.tag) == "content"), "")
        path, _, anchor = src.partition("#")
        out.append({"title": label, "href": _resolve(base, path), "anchor": anchor, "depth": depth})
        _nav_points(p, base, depth + 1, out)


def _nav_list(node, base: str, depth: int, out: list) -> None:
    """Entries of the nested lists of an EPUB 3 navigation document."""
    for item in (c for c in node if _local(c.tag) == "li"):
        label = next((c for c in item if _local(c.tag) in ("a", "span")), None)
        if label is not None:
            path, _, anchor = label.get("href", "").partition("#")
            title = " ".join("".join(label.itertext()).split())
            if title:
                out.append({"title": title, "href": _resolve(base, path), "anchor": anchor, "depth": depth})
        for inner in (c for c in item if _local(c.tag) == "ol"):
            _nav_list(inner, base, depth + 1, out)


def _nav(page: bytes, base: str) -> list[dict]:
    out: list[dict] = []
    for nav in (e for e in ElementTree.fromstring(page).iter() if _local(e.tag) == "nav"):
        if any(_local(k) == "type" and v == "toc" for k, v in nav.attrib.items()):
            for inner in (c for c in nav if _local(c.tag) == "ol"):
                _nav_list(inner, base, 0, out)
    return out


class _Archive(zipfile.ZipFile):
    def read(self, name, pwd=None):
        if self.getinfo(name).file_size > MAX_ITEM:
            raise ValueError(f"{name} is larger than {MAX_ITEM} bytes")
        return super().read(name, pwd)


def read_epub(data: bytes) -> dict:
    """Metadata, spine and table of contents of one file.

    The contents come from the NCX file or, without entries there, from the
    navigation document of EPUB 3. Several creators are joined by commas.
    """
    z = _Archive(io.BytesIO(data))
    names = z.namelist()
    opf = None
    if "META-INF/container.xml" in names:
        opf = next((e.get("full-path") for e in ElementTree.fromstring(z.read("META-INF/container.xml")).iter() if _local(e.tag) == "rootfile"), None)
    opf = opf or next(n for n in names if n.endswith(".opf"))
    base, root = opf.rpartition("/")[0], ElementTree.fromstring(z.read(opf))
    manifest = {e.get("id"): (_resolve(base, e.get("href", "")), e.get("media-type", "")) for e in root.iter() if _local(e.tag) == "item"}
    spine = []
    for ref in (e for e in root.iter() if _local(e.tag) == "itemref"):
        href, kind = manifest.get(ref.get("idref"), ("", ""))
        if "html" in kind and href in names:
            spine.append({"spine_index": len(spine), "href": href, "text": plain_text(z.read(href).decode("utf-8", "replace"))})
    toc: list[dict] = []
    ncx = next((h for h, kind in manifest.values() if kind.endswith("ncx+xml") and h in names), None)
    if ncx:
        for e in ElementTree.fromstring(z.read(ncx)).iter():
            if _local(e.tag) == "navMap":
                _nav_points(e, ncx.rpartition("/")[0], 0, toc)
    page = next((_resolve(base, e.get("href", "")) for e in root.iter() if _local(e.tag) == "item" and "nav" in e.get("properties", "").split()), None)
    if not toc and page in names:
        toc = _nav(z.read(page), page.rpartition("/")[0])
    creators = [e.text.strip() for e in root.iter() if _local(e.tag) == "creator" and e.text and e.text.strip()]
    return {"title": _first(root, "title"), "author": ", ".join(creators) or None, "language": _first(root, "language"), "spine": spine, "toc": toc}


def scan(spark: SparkSession, path: str) -> DataFrame:
    """One row for each .epub file under ``path``; what cannot be read has an error."""
    import pandas as pd

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.epub").load(path)

    def run(batches):
        for pdf in batches:
            rows = []
            for p, h, content in zip(pdf["path"], pdf["source_hash"], pdf["content"], strict=True):
                row = dict.fromkeys(("title", "author", "language", "spine", "toc", "error"))
                try:
                    row |= read_epub(content)
                except Exception as e:  # noqa: BLE001  one bad file must not stop the scan
                    row["error"] = str(e)[:200] or type(e).__name__
                rows.append({"path": p, "source_hash": h, **row})
            yield pd.DataFrame(rows, columns=["path", "source_hash", "title", "author", "language", "spine", "toc", "error"])

    return files.select("path", F.sha2("content", 256).alias("source_hash"), "content").mapInPandas(run, SCHEMA)


def spine_items(books: DataFrame) -> DataFrame:
    """(source_hash, spine_index, href, text, line_offset): texts of a book join by a blank line."""
    s = books.select("source_hash", F.explode("spine").alias("s")).select("source_hash", "s.*")
    n = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 2
    w = Window.partitionBy("source_hash").orderBy("spine_index").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumn("line_offset", F.coalesce(F.sum(n).over(w), F.lit(0)))


def combined_text(books: DataFrame) -> DataFrame:
    """(source_hash, text): the spine's texts in order, with a blank line between."""
    return books.select("source_hash", F.array_join(F.transform(F.array_sort("spine"), lambda s: s["text"]), "\n\n").alias("text"))


def toc_titles(books: DataFrame, skip: str = r"(?i)^introduction$") -> DataFrame:
    """(source_hash, titles): titles of the contents in order, without front and back matter and what ``skip`` matches."""
    t = F.filter("toc", lambda e: ~should_skip_title(e["title"]) & ~F.trim(e["title"]).rlike(skip) & (F.trim(e["title"]) != ""))
    return books.select("source_hash", F.transform(t, lambda e: F.trim(e["title"])).alias("titles"))


def split_points(books: DataFrame) -> DataFrame:
    """Entries of the table of contents joined with the spine, without front and back matter.

    Spine items of over 100 words that no entry names give a point of their own.
    """
    items = spine_items(books)
    toc = books.select("source_hash", F.posexplode("toc").alias("seq", "t")).select("source_hash", "seq", "t.*").filter(~should_skip_title(F.col("title")))
    named = toc.join(items.select("source_hash", "href", "spine_index", "line_offset"), ["source_hash", "href"])
    rest = items.join(books.select("source_hash", F.explode("toc").alias("t")).select("source_hash", F.col("t.href").alias("href")).distinct(), ["source_hash", "href"], "left_anti")
    rest = rest.filter(F.size(F.split("text", r"\s+")) > 100)
    made = rest.select("source_hash", "href", F.lit(1 << 30).alias("seq"), F.concat(F.lit("Section "), F.col("spine_index") + 1).alias("title"), F.lit("").alias("anchor"), F.lit(0).alias("depth"), "spine_index", "line_offset")
    return named.unionByName(made)


def chapter_depth(points: DataFrame) -> DataFrame:
    """Only the top level where it has any points, else the first two."""
    top = F.max((F.col("depth") == 0).cast("int")).over(Window.partitionBy("source_hash"))
    return points.withColumn("__top", top).filter((F.col("depth") == 0) | ((F.col("__top") == 0) & (F.col("depth") <= 1))).drop("__top")

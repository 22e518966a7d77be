"""Command line: ``python -m quirespark.cli COMMAND ...``.

process PATH LIBRARY   take up new files        list LIBRARY      books
audit LIBRARY          validation messages      quality LIBRARY   scores, the worst first
report LIBRARY         quality as Markdown      merges LIBRARY    what merging would bring
chapters LIBRARY BOOK  a book's chapters
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import api
from .operators import reports


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quirespark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    x = sub.add_parser("process")
    x.add_argument("path")
    x.add_argument("library")
    x.add_argument("--merge", action="store_true", help="merge small neighbours")
    x.add_argument("--raw", action="store_true", help="leave the text as it is")
    x.add_argument("--max-tokens", type=int, help="estimated tokens of a section")
    x.add_argument("--config", help="JSON file of options")
    for name in ("list", "audit", "quality", "report", "merges"):
        y = sub.add_parser(name)
        y.add_argument("library")
        y.add_argument("--limit", type=int, default=50, help="rows shown")
        y.add_argument("--json", action="store_true")
    z = sub.add_parser("chapters")
    z.add_argument("library")
    z.add_argument("book")
    z.add_argument("--limit", type=int, default=200)
    z.add_argument("--json", action="store_true")
    return p


def _rows(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.command == "list":
        return api.completed(spark, a.library, "books").select("book_id", "title", "author", "word_count", "method")
    if a.command == "chapters":
        return api.completed(spark, a.library, "chapters").filter(F.col("book_id") == a.book).select("chapter_number", "title", "word_count").orderBy("chapter_number")
    if a.command == "report":
        empty = F.array().cast("array<string>")
        return reports.quality_report(api.quality(spark, a.library).withColumn("warnings", empty).withColumn("info", empty)).select("report")
    return {"audit": api.audit, "quality": api.quality, "merges": api.preview_merges}[a.command](spark, a.library)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("quirespark").getOrCreate()
    if a.command == "process":
        o = api.load_options(a.config)
        o = replace(o, merge=a.merge or o.merge, clean=o.clean and not a.raw, max_section_tokens=a.max_tokens or o.max_section_tokens)
        batch = api.ingest(spark, a.path, a.library, o)
        print(f"batch {batch}" if batch else "nothing new")
        return 0
    if api.table(spark, a.library, "books") is None:
        print(f"no library in {a.library}", file=sys.stderr)
        return 1
    rows = _rows(spark, a)
    shown = rows.select(F.to_json(F.struct(*rows.columns)).alias("row")) if a.json else rows
    for r in shown.limit(a.limit).collect():  # --limit bounds what comes to the driver
        print(r[0] if len(shown.columns) == 1 else "  ".join(map(str, r)))
    return 0


if __name__ == "__main__":
    sys.exit(main())

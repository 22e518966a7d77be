"""Line dedup on all character shingles, its bands and its short lines."""

import random

import pytest
from pyspark.sql import functions as F

from quirespark.llm import line_dedup, registry


def test_lines_of_few_words_are_compared_by_all_characters(spark):
    far = ["https://www.example.com/reports/2021/q3.pdf", "https://www.other.org/about-us/team.html"]
    long = "".join(random.Random(3).choices("abcdefghij", k=200))
    near = [long, "?" + long, long + "?", long[:100] + "?" + long[100:]]
    df = spark.createDataFrame(list(enumerate(far + near)), "doc_id long, text string")
    assert {r.doc_id: r.removed for r in line_dedup.decisions(df).collect()} == {0: [], 1: [], 2: [], 3: [0], 4: [0], 5: [0]}


@pytest.mark.parametrize(("length", "least"), [(24, 1), (29, 1), (38, 0.995), (47, 0.995), (56, 0.995), (101, 0.995), (200, 0.995)])
def test_bands_find_pairs_at_the_threshold(spark, length, least):
    """Pairs of lines of ``length`` of which the last characters differ, at 0.8 or just above."""
    rng = random.Random(length)
    n = length - line_dedup.WINDOW + 1
    d = max(d for d in range(n) if 10 * (n - d) >= 8 * (n + d))
    rows = []
    for i in range(2000):
        x = "".join(rng.choices("abcdefghij", k=length))
        rows += [(i, x), (i, x[: length - d] + "?" * d)] if d < line_dedup.WINDOW else [(i, x), (i, x[: length - d] + "".join(rng.choices("klmnop", k=d)))]
    df = spark.createDataFrame([(2 * i + j % 2, line) for j, (i, line) in enumerate(rows)], "id long, line string")
    found = line_dedup.add_bands(df, df)
    found = found.groupBy("id").agg(F.flatten(F.collect_list("bands")).alias("bands"))
    sides = found.groupBy(F.expr("id div 2").alias("pair")).agg(F.collect_list("bands").alias("x"))
    share = sides.agg(F.avg(F.arrays_overlap(F.get("x", F.lit(0)), F.get("x", F.lit(1))).cast("int"))).first()[0]
    assert share >= least


def test_query_removes_repeated_short_lines(spark, tmp_path):
    rows = [(1, "All rights reserved.\n\nA"), (2, " all rights reserved.\n\n\t\na"), (3, "All rights reserved!\nall rights reserved.\r"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.op8_line_dedup(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_lines, r.removed) for r in got} == {1: (3, []), 2: (4, [0, 3]), 3: (2, []), 4: (0, [])}


def test_bands_of_parts_find_more_pairs_than_bands_of_whole_sets(spark):
    """Of pairs at 0.8 with 45 windows, bands that are independent of each other miss 0.0032."""
    rng = random.Random(56)
    rows = []
    for i in range(4000):
        x = "".join(rng.choices("abcdefghij", k=56))
        rows += [(2 * i, x), (2 * i + 1, x[:51] + "?" * 5)]
    df = spark.createDataFrame(rows, "id long, line string")
    found = line_dedup.add_bands(df, df).select(F.expr("id div 2").alias("pair"), "id", F.explode("bands").alias("key")).distinct()
    assert found.groupBy("pair", "key").count().filter("count > 1").select("pair").distinct().count() >= 0.999 * 4000

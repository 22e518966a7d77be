"""Fuzzy line dedup across documents, by DataFrame operations only.

A line of MIN_CHARS or more takes part; shorter ones are structure and stay,
unless ``short`` is set: then those that are not blank take part in the classes
of equal lines, though not in the links of near copies. A line's shingles are the
windows of WINDOW characters (UTF-16 units) at every position of the line in
lower case, as 64-bit hashes, in the signatures and in the comparison. Lines of
one hash are one class. The windows are exploded and aggregated within generated
code. The lowest bits of a window's hash name one of BANDS parts of the line's set, and
the ROWS minima of each part, under other orders of the hash, make a band. A pair
at similarity s shares one with probability 1 - (1 - s^ROWS)^BANDS, 0.997
at 0.8, or more, as the similarities of the parts have s for their mean and
log(1 - s^ROWS) is concave. Lines of at most FEW distinct shingles are also found exactly. Classes
that share a band are compared by the exact Jaccard similarity of their shingle
sets and linked at ``num`` of 100; linked classes form components, of which the
first occurrence (by doc_id, then position) stays and all other lines go.

Exact search is by prefixes: of two sets that share t hashes or more, each has
the two smallest shared ones among its n - t + 2 smallest, so every pair of
those is a key. Sizes of linked sets differ by num/100 at most, so lines up to
100/num times FEW have these keys.
tests/llm/test_line_dedup.py measures the recall.

Defined results: a null text stays null, an empty one empty; blank lines stay; equal lines within a document count as copies too; rows
that are equal in id and text get the same decisions; a null id comes after all
others in the order of occurrences. Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, fresh, prefilter, release, unplaced
from .graph import bucket_components, shared_buckets

MIN_CHARS = 24
WINDOW = 12
BANDS = 8  # a power of 2
ROWS = 3
NUM = 80

#: Longs of a sketch of a shingle set.
SKETCH = 16
#: Distinct shingles up to which lines are found exactly.
FEW = 24
#: Shingles of a set that later rounds carry with its sketch, so that only links become pairs.
CARRIED = 2048
#: Members of a bucket above which it is cut into cells of as many against as many; a comparison of sketches takes 0.1 microseconds or less.
SMALL = 2000
#: Bits by which a hash is shifted to the left for each order: other bits lead in each.
_SHIFT = 20
_LAST = (1 << 63) - 1


def plain(line: Column) -> Column:
    return F.lower(F.trim(line))


def _windows_sql(units: str) -> str:
    return f"flatten(transform(array({units}), x -> transform(sequence(1, octet_length(x) - {2 * WINDOW - 1}, 2), i -> xxhash64(substring(x, i, {2 * WINDOW})))))"


def _windows(units: str) -> Column:
    """Hashes of the windows over a line's UTF-16 units, a binary column; at 2 bytes a unit each is cut out at once.

    The bytes go through a variable of their own, as those of a column would be
    copied for each window.
    """
    return F.expr(_windows_sql(units))


def _grams_sql(line: str) -> str:
    return _windows_sql(f"encode({line}, 'UTF-16BE')")


def grams(line: str) -> Column:
    """Hashes of the windows of the column ``line``, of MIN_CHARS or more characters, in order."""
    return F.expr(_grams_sql(line))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(doc_id, text)


def lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """(doc_id, rid, pos, line) of the lines that take part; ``line`` is plain."""
    # both before the lines: above the generator the text would be hashed for each line, and each use of a line make it plain anew
    rows = docs.select("doc_id", row_key().alias("rid"), F.transform(F.split("text", "\n"), plain).alias("all"))
    all_lines = rows.select("doc_id", "rid", F.posexplode("all").alias("pos", "line"))
    long_enough = F.length("line") >= MIN_CHARS
    return all_lines.filter(long_enough | F.col("line").rlike(r"\S") if short else long_enough)


def few_chars(num: int) -> int:
    """Characters up to which a line may be found exactly; with more it has bands for all its links."""
    return FEW * 100 // num + WINDOW - 1


def _exploded(lines_: DataFrame) -> DataFrame:
    """(id, x): the hash of every window of the lines (id, line)."""
    units = lines_.filter(F.length("line") >= MIN_CHARS).select("id", F.encode("line", "UTF-16BE").alias("b"))
    each = units.select("id", "b", F.explode(F.expr(f"sequence(1, octet_length(b) - {2 * WINDOW - 1}, 2)")).alias("i"))
    return each.select("id", F.expr(f"xxhash64(substring(b, i, {2 * WINDOW}))").alias("x"))


def add_bands(lines_: DataFrame, short_lines: DataFrame, num: int = NUM) -> DataFrame:
    """(id, bands) of the lines (id, line) of MIN_CHARS or more; a line has several rows.

    Keys of the minima for all of ``lines_``, a row for each part of a line's set, those of the
    prefixes for lines of few shingles among ``short_lines``.
    """
    parts = _exploded(lines_).groupBy("id", F.expr(f"x & {BANDS - 1}L").alias("part"))
    minima = parts.agg(*[F.min(F.shiftleft("x", _SHIFT * j)).alias(f"m{j}") for j in range(ROWS)])
    out = minima.select("id", F.array(F.xxhash64("part", *[f"m{j}" for j in range(ROWS)])).alias("bands"))

    few = short_lines.filter(F.length("line").between(MIN_CHARS, few_chars(num))).withColumn("b", F.encode("line", "UTF-16BE"))
    few = few.withColumn("s", F.sort_array(F.array_distinct(_windows("b")))).withColumn("n", F.size("s")).filter(F.col("n") * num <= FEW * 100)
    # the least intersection of a link is num % of the set, rounded up
    few = few.withColumn("p", F.expr(f"slice(s, 1, n - cast(floor((n * {num} + 99) / 100) as int) + 2)"))
    pairs = F.expr("flatten(transform(p, (x, i) -> transform(slice(p, i + 2, size(p)), y -> xxhash64(x, y))))")
    return out.unionByName(few.select("id", F.when(F.col("n") == 1, F.array(F.xxhash64(F.get("s", F.lit(0))))).otherwise(pairs).alias("bands")))


def _enough(x: str, y: str, both: Column, num: int) -> Column:
    """Whether an intersection of ``both`` links the sides; they have sizes ``n``."""
    return both * (100 + num) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * num


def _may_link(x: str, y: str, num: int) -> Column:
    """Whether sizes and sketches, which bound the intersection from above, leave a link possible.

    Each bit that one sketch alone has set stands for a shingle at least that one set alone has.
    The sum is a higher-order function, which keeps a join under this condition out of
    whole-stage code: written out, the joins took about three times the CPU seconds,
    supposedly as a method of over 8,000 bytes is not compiled by the JVM.
    """
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    common = F.expr(f"aggregate(zip_with({x}.bits, {y}.bits, (p, q) -> bit_count(p & q)), 0, (s, b) -> s + b)")
    most = common + F.least(nx - F.col(f"{x}.ones"), ny - F.col(f"{y}.ones"))
    return _enough(x, y, F.least(nx, ny), num) & _enough(x, y, most, num)


def _known(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line, n, bits, ones) of the lines in ``ids``, read from the texts once.

    n counts distinct shingles, ``ones`` the bits set in the sketch.
    """
    # an inner join: a semi join would be moved below the filter
    found = prefilter(lines(docs).select(F.xxhash64("line").alias("id"), "line"), "id", ids).join(ids, "id")
    found = checkpoint(found.groupBy("id").agg(F.first("line").alias("line")).select(unplaced("id"), "line"))
    words = _exploded(found).groupBy("id", F.expr(f"x & {SKETCH - 1}L").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(x, 8) & 63 as int))")).alias("b"))
    bits = words.groupBy("id").agg(*[F.bit_or(F.expr(f"if(w = {w}, b, 0L)")).alias(f"b{w}") for w in range(SKETCH)])
    ones = sum((F.bit_count(f"b{w}") for w in range(1, SKETCH)), F.bit_count("b0"))
    bits = bits.select("id", F.array(*[f"b{w}" for w in range(SKETCH)]).alias("bits"), ones.alias("ones"))
    out = checkpoint(found.select("id", "line", F.size(F.array_distinct(grams("line"))).alias("n")).join(bits, "id"))
    release(found)
    return out


def _verified(pairs: DataFrame, known: DataFrame, num: int) -> DataFrame:
    """Those of the pairs (a, b) of line hashes with a Jaccard similarity of num/100.

    Lines travel as texts, which are shorter than their sets; sets are made for
    the pairs that sizes and sketches leave.
    """
    side = F.struct("n", "bits", "ones", "line")
    p = pairs.join(known.select(F.col("id").alias("a"), side.alias("x")), "a").join(known.select(F.col("id").alias("b"), side.alias("y")), "b")
    p = p.filter(_may_link("x", "y", num)).withColumn("l1", F.col("x.line")).withColumn("l2", F.col("y.line"))
    return p.filter(_enough("x", "y", F.size(F.array_intersect(grams("l1"), grams("l2"))), num)).select("a", "b")


def _components(each: DataFrame, docs: DataFrame, num: int) -> DataFrame | None:
    """(node, component) of the line hashes ``id`` of ``each`` (id, bands), a table that is used up."""
    buckets = shared_buckets(each.select("id", F.explode("bands").alias("key")))
    release(each)
    known = _known(docs, buckets.select("id").distinct())

    def traits(ids: DataFrame) -> DataFrame:
        low = F.transform(grams("line"), lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int"))
        t = known.join(ids, "id", "left_semi").withColumn("g", F.when(F.col("n") <= CARRIED, F.array_distinct(low))).drop("line")
        # halves of hashes that are equal would count as one
        return checkpoint(t.withColumn("g", F.when(F.size("g") == F.col("n"), F.col("g"))))

    def close(x: str, y: str) -> tuple[Column, Column]:
        both = F.size(F.array_intersect(f"{x}.g", f"{y}.g"))
        return _may_link(x, y, num), F.when(F.col(f"{x}.g").isNull() | F.col(f"{y}.g").isNull(), True).otherwise(_enough(x, y, both, num))

    found = bucket_components(buckets, lambda pairs: _verified(pairs, known, num), traits, close, SMALL)
    release(buckets, known)
    return found


def removed(docs: DataFrame, num: int = NUM, short: bool = False) -> DataFrame:
    """(rid, gone): positions of the lines to remove, of the rows that have any."""
    cut = lines(docs, short).select(F.xxhash64("line").alias("id"), "doc_id", "rid", "pos", "line")
    each = checkpoint(cut.withColumn("line", F.when(F.length("line").between(MIN_CHARS, few_chars(num)), F.col("line"))))
    found = _components(checkpoint(add_bands(cut, each, num)), docs, num)
    # lines that have copies or near copies; all others are out of the matter
    many = each.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id", F.lit(None).cast("long").alias("component"))
    if found is not None:
        many = many.unionByName(found.select(F.col("node").alias("id"), "component"))
    many = checkpoint(many.groupBy("id").agg(F.coalesce(F.max("component"), "id").alias("component")))
    at = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc_id"), "rid", "pos").alias("at")
    rows = prefilter(each.select("id", at), "id", many).join(many.select(unplaced("id"), "component"), "id").select("component", "at")
    rows = checkpoint(rows)
    release(each)
    stays = rows.groupBy("component").agg(F.min("at").alias("stays")).select(unplaced("component"), "stays")
    gone = rows.join(stays, "component").filter("at <> stays")
    return gone.groupBy(F.col("at.rid").alias("rid")).agg(F.array_sort(F.collect_set("at.pos")).alias("gone"))


def decisions(docs: DataFrame, num: int = NUM, short: bool = False) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (positions) of every row; no text is moved."""
    gone = removed(docs, num, short).withColumnRenamed("rid", "__rid")
    rows = docs.select("doc_id", row_key().alias("__key"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n"))
    out = rows.join(gone, F.col("__key") == F.col("__rid"), "left").withColumn("removed", F.coalesce("gone", F.array().cast("array<int>")))
    return out.select("doc_id", F.greatest("n", F.lit(0)).cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), "removed")


def dedup(docs: DataFrame, num: int = NUM, short: bool = False) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``."""
    key, rid, gone = fresh(docs, "__key", "__rid", "__gone")
    lost = removed(docs.select("doc_id", "text"), num, short).toDF(rid, gone)
    joined = docs.withColumn(key, row_key()).join(lost, F.col(key) == F.col(rid), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col(gone), i)), "\n")
    out = joined.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept))
    return out.drop(key, rid, gone)

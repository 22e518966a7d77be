"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order, null last, get weights in a cycle and
share ``budget`` times the words of all documents; a target stops at
``max_passes`` times its source's words, and the excess is shared among the
others by weight until none is above. With sources sorted by the share of the
budget that fills them, the level of this water-filling is the largest of the
levels found with the first k sources full, so it needs sorted sums only.

Demand: a source's documents stand in a fixed order, by a hash of their id, and
the mix takes the first ``target`` words of their repeated sequence. What a
document gives is where its words meet that range, pass by pass; the total of a
source is its target to the word, and no document gives more than
``max_passes`` times its size.

Curriculum: over training time 0..1 a source's weight is its target times a
piecewise linear schedule. Its integral is the source's cumulated demand, and
inverting that at the middle of the words that a document gives in a pass gives
the time at which the document is trained on in that pass; each pass has a
position of its own. Documents are range-sorted by the first.

Defined results: a null text has size 0; documents of size 0 and those beyond
the target take 0 and have no position (they come last); null is a source of
its own; repeated rows each count and each give; an empty table gives no rows.
Positions of a source are cut by (hash, id), which any rerun repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, checkpoint, fresh
from .prefix import before


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)
    budget: float = 1.5
    max_passes: int = 2
    #: Times of the knots, and each rank's multipliers there (in a cycle).
    knots: tuple[float, ...] = (0.0, 0.5, 1.0)
    schedules: tuple[tuple[float, ...], ...] = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5), (0.75, 1.25, 0.75))


PRODUCTION = Mix()


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"))


def _cycle(values, rank: Column) -> Column:
    out = None
    for i, v in enumerate(values):
        hit = rank % len(values) == i
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return out


def targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """A row for each source: rank from 0, source_size, weight, target.

    The windows run over one row for each source, not over documents.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
    s = s.withColumn("weight", _cycle(mix.weights, F.col("rank")).cast("long"))
    full = F.col("source_size") * mix.max_passes
    by = [full.cast("double") / F.col("weight"), F.col("rank")]
    earlier = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    on = Window.orderBy(*by).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(mix.budget) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum(full).over(earlier), F.lit(0))) / F.sum("weight").over(on)
    s = s.withColumn("__level", level)
    top = F.max("__level").over(all_rows)
    return s.withColumn("target", F.least(full.cast("double"), top * F.col("weight"))).drop("__level")


def position(share: Column, rank: Column, mix: Mix) -> Column:
    """Time 0..1 at which a source's demand reaches ``share`` of its total."""
    per_rank = []
    for s in mix.schedules:
        at, areas = mix.knots, [0.0]
        for j in range(len(at) - 1):
            areas.append(areas[-1] + (at[j + 1] - at[j]) * (s[j] + s[j + 1]) / 2)
        need = share * F.lit(areas[-1])
        time = None
        for j in range(len(at) - 1):
            rest, slope = need - F.lit(areas[j]), (s[j + 1] - s[j]) / (at[j + 1] - at[j])
            # rest = s_j x + slope x^2 / 2, in the form that is stable for small slopes
            root = F.lit(s[j]) + F.sqrt(F.greatest(F.lit(0.0), F.lit(s[j] * s[j]) + F.lit(2 * slope) * rest))
            x = F.lit(at[j]) + F.when(root > 0, F.lit(2.0) * rest / root).otherwise(F.lit(0.0))
            hit = need <= F.lit(areas[j + 1])
            time = F.when(hit, x) if time is None else time.when(hit, x)
        per_rank.append(time.otherwise(F.lit(at[-1])))
    out = None
    for i, time in enumerate(per_rank):
        hit = rank % len(per_rank) == i
        out = F.when(hit, time) if out is None else out.when(hit, time)
    return out


def mix(docs: DataFrame, params: Mix = PRODUCTION) -> DataFrame:
    """doc_id, size, source_size, target, taken, position, positions of every document.

    ``positions`` has one for each pass that takes words of the document,
    ``position`` is the first of them, by which the rows are sorted.
    """
    sized = checkpoint(sizes(docs.select("doc_id", "source", "text")).drop("text"))
    of_source = targets(sized, params)
    joined = sized.join(of_source.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s", "source", "weight")
    joined = joined.withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = [F.col("key"), F.col("doc_id"), F.col("size")]
    laid = before(joined, "rank", order, "size", "start")
    whole = F.floor("target")
    gives = [F.greatest(F.lit(0), F.least(F.col("size"), whole - F.col("start") - F.col("source_size") * p)) for p in range(params.max_passes)]
    taken = sum(gives[1:], gives[0])
    out = laid.withColumn("taken", taken.cast("long"))

    def at(p: int) -> Column:
        share = (F.col("start") + F.col("source_size") * p + gives[p].cast("double") / F.lit(2.0)) / whole
        return F.when(gives[p] > 0, position(share, F.col("rank"), params))

    out = out.withColumn("positions", F.array_compact(F.array(*[at(p) for p in range(params.max_passes)])))
    out = out.withColumn("position", F.get("positions", F.lit(0)))
    by = [F.col("position").asc_nulls_last(), F.col("key"), F.col("doc_id")]
    out = out.repartitionByRange(*by).sortWithinPartitions(*by)
    return out.select("doc_id", "size", "source_size", "target", "taken", "position", "positions")


def passes(docs: DataFrame, params: Mix = PRODUCTION) -> DataFrame:
    """``docs`` as the mix takes them: a row for each pass begun, in the order of positions.

    A document that the end of its source's demand falls into is taken whole.
    Rows that share an id are taken alike: as often as the one taken most.
    """
    id_, positions, at = fresh(docs, "__id", "__positions", "__at")
    most = F.max(F.struct(F.size("positions").alias("n"), "positions"))
    taken = mix(docs, params).filter("taken > 0").groupBy(F.col("doc_id").alias(id_)).agg(most["positions"].alias(positions))
    out = docs.join(taken, docs["doc_id"].eqNullSafe(F.col(id_))).withColumn(at, F.explode(positions))
    return out.repartitionByRange(at, id_).sortWithinPartitions(at, id_).drop(id_, positions, at)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank FROM sized GROUP BY source
), w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
     - coalesce(sum(source_size * 2) OVER (ORDER BY (source_size * 2)::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
     / (sum(weight) OVER (ORDER BY (source_size * 2)::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w
), t AS (
  SELECT *, least((source_size * 2)::DOUBLE, (max(level) OVER ()) * weight) AS target FROM l
), d AS (
  SELECT sized.doc_id, sized.size, t.source_size, t.target, t.rank, floor(t.target)::BIGINT AS whole,
    coalesce(sum(sized.size) OVER (PARTITION BY t.rank ORDER BY md5(coalesce(sized.doc_id::VARCHAR, '')), sized.doc_id, sized.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source
), g AS (
  SELECT *, greatest(0, least(size, whole - start)) AS first, greatest(0, least(size, whole - start - source_size)) AS second FROM d
), p AS (
  SELECT *, (start + first::DOUBLE / 2.0) / whole::DOUBLE AS share1, (start + source_size + second::DOUBLE / 2.0) / whole::DOUBLE AS share2 FROM g
), u AS (
  SELECT *, unnest([1, 2]) AS pass, unnest([share1, share2]) AS share, unnest([first, second]) AS given FROM p
), c AS (
  SELECT *, CASE WHEN given > 0 THEN CASE rank % 3
    WHEN 0 THEN CASE WHEN share <= 0.625 THEN 2.0 * share / (1.5 + sqrt(greatest(0.0, 2.25 - 2.0 * share)))
                     ELSE 0.5 + 2.0 * (share - 0.625) / (1.0 + sqrt(greatest(0.0, 1.0 - 2.0 * (share - 0.625)))) END
    WHEN 1 THEN CASE WHEN share <= 0.375 THEN 2.0 * share / (0.5 + sqrt(greatest(0.0, 0.25 + 2.0 * share)))
                     ELSE 0.5 + 2.0 * (share - 0.375) / (1.0 + sqrt(greatest(0.0, 1.0 + 2.0 * (share - 0.375)))) END
    ELSE CASE WHEN share <= 0.5 THEN 2.0 * share / (0.75 + sqrt(greatest(0.0, 0.5625 + 2.0 * share)))
                     ELSE 0.5 + 2.0 * (share - 0.5) / (1.25 + sqrt(greatest(0.0, 1.5625 - 2.0 * (share - 0.5)))) END
  END END AS position FROM u
)
SELECT x.doc_id, x.size, x.source_size, x.target, (x.first + x.second)::BIGINT AS taken,
  coalesce(x.position, y.position) AS position, CASE WHEN x.position IS NOT NULL THEN y.position END AS position_2
FROM (SELECT * FROM c WHERE pass = 1) x JOIN (SELECT * FROM c WHERE pass = 2) y ON x.doc_id IS NOT DISTINCT FROM y.doc_id AND x.rank = y.rank AND x.start = y.start AND x.size = y.size
"""

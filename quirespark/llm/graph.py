"""Connected components of an edge list, by DataFrame operations only.

Alternating large-star and small-star steps (Kiveris et al., 2014) move every
node to the smallest id of its component; each step is an aggregation with
map-side combining and a join, and needs a logarithmic number of rounds. Edges
and labels stay on the cluster: the driver sees a count and a checksum.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, prefilter, release, unplaced

#: Edges that one task handles; more are dealt out.
ONE_TASK = 200_000
#: Centres of a bucket in the second round.
CENTRES = 8


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(0xFFFFFFFF))).first()
    return tuple(row)


def _with_smallest(edges: DataFrame, few: bool) -> DataFrame:
    """Each edge with ``m``, the smallest of u and all its v.

    By a window within one task for few edges, which needs no exchange; else
    by an aggregation and a join, so that a node of very many edges can be split.
    """
    if few:
        return edges.withColumn("m", F.least("u", F.min("v").over(Window.partitionBy("u"))))
    m = edges.groupBy("u").agg(F.min("v").alias("m")).select(unplaced("u"), F.least("u", "m").alias("m")).withColumnRenamed("u", "w")
    return edges.join(m, F.col("u") == F.col("w"))


def _two(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Both edges of every row; a union would part what one task holds."""
    return df.select(F.explode(F.array(a, b)).alias("x")).select("x.u", "x.v")


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; component is the smallest id.

    ``a`` and ``b`` are long and not null. Loops and repeated edges do no harm;
    an edge to itself alone gives no row. ``edges`` is read more than once.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    state, table = _state(e), None
    for _ in range(max_rounds):
        if not state[0]:
            break
        few = state[0] <= ONE_TASK
        e = e.coalesce(1) if few else e  # exchanges would take longer than the work
        # large star: neighbours above a node go to the smallest around it
        both = _with_smallest(_two(e, F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))), few)
        large = both.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its neighbours below go to the smallest of these
        joined = _with_smallest(large, few)
        small = _two(joined, F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        past, table = table, checkpoint(small.filter("u <> v").distinct())
        if past is not None:
            release(past)
        e = table
        now = _state(e)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def shared_buckets(members: DataFrame) -> DataFrame:
    """Distinct (key, id) of the keys that more than one id has, as a table.

    Keys are counted with map-side combining, so that a hot key moves a row for
    each task; most members of other keys are dropped where they are read.
    """
    keys = members.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi").select("key")
    keys = checkpoint(keys)
    some = prefilter(members, "key", keys, "key").select("key", "id")
    out = checkpoint(some.join(keys.select(unplaced("key")), "key").distinct())
    release(keys)
    return out


def _several(buckets: DataFrame) -> DataFrame:
    """Members (key, id, label, ...) of the buckets of several labels, with ``members``, the number of those of the bucket."""
    keys = buckets.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members")).filter("lo <> hi")
    return buckets.join(keys.select(unplaced("key"), "members"), "key")


def _across(x: DataFrame, y: DataFrame, order: Column, close: Callable[[str, str], tuple[Column, Column]]) -> DataFrame:
    """Pairs (a, b) within cells that are ``close``; all others are never made.

    A pair that meets in several buckets is compared in full in the first of them only.
    """
    quick, full = close("x", "y")
    once = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key")
    pairs = x.alias("x").join(y.alias("y"), (F.col("x.cell") == F.col("y.cell")) & order & quick & once & full)
    return pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _cells(rest: DataFrame, known: DataFrame, small: int | None = None) -> DataFrame:
    """Members with their traits, a row for each bucket, or for each cell of a bucket of over ``small`` members.

    The members of a large bucket are dealt to tiles of about ``small``; every two tiles
    make a cell, and every tile one with itself, so that any two members meet in one
    cell and cells can be worked on by many tasks. Traits are joined to a row a member.
    """
    each = rest.groupBy("id").agg(F.max("label").alias("label"), F.collect_list(F.struct("key", "members")).alias("at")).join(known, "id")
    tiles = "1L" if small is None else f"cast(ceil(m.members / {small}) as long)"
    at = F.expr(f"flatten(transform(at, m -> transform(sequence(0L, {tiles} - 1L), j -> named_struct('key', m.key, 'members', m.members, 'tile', pmod(xxhash64(id), {tiles}), 'other', j))))")
    rows = each.select("id", "label", F.col("at.key").alias("keys"), *[c for c in known.columns if c != "id"], F.explode(at).alias("m")).select("*", "m.*").drop("m")
    cell = F.col("key") if small is None else F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other"))
    return rows.withColumn("cell", cell)


def bucket_components(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    traits: Callable[[DataFrame], DataFrame],
    close: Callable[[str, str], tuple[Column, Column]],
    small: int,
) -> DataFrame | None:
    """(node, component) of the nodes linked within buckets; None if there are none.

    ``buckets`` are those of ``shared_buckets``; ``verify`` returns those of the
    pairs (a, b) that are links. First every member is compared with one centre
    of each of its buckets, another in each bucket, and what is linked is
    contracted. In buckets that still hold several components, members are
    compared with CENTRES others or so, at random, and contracted once more,
    which leaves those that are linked with few or none. These are compared with
    all members of other components in each of their buckets, whatever its size: no pair that
    shares a bucket is left out. Buckets of over ``small`` members are cut into cells
    for that, which spread over tasks. No pair is made that isn't
    ``close``, a quick condition and a full one on the columns of ``traits`` (a function of a
    table of (id) that returns one of (id, ...)) of both sides; so rows grow with the
    members of a bucket, over ``small`` with a ``small``-th of their square, and comparisons
    with the square of those in buckets of several components.
    """
    centre = buckets.groupBy("key").agg(F.min(F.struct(F.col("id").bitwiseXOR(F.col("key")).alias("x"), "id")).alias("c"))
    first = buckets.join(centre.select(unplaced("key"), F.col("c.id").alias("other")), "key").filter("id <> other")
    edges = checkpoint(verify(first.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()))

    def left(found: DataFrame | None) -> DataFrame:
        if found is None:
            return checkpoint(_several(buckets.withColumn("label", F.col("id"))).filter("members > 2"))
        labelled = buckets.join(found.select(unplaced("node"), "component"), F.col("id") == F.col("node"), "left")
        # of two members the first centre has compared the only pair
        return checkpoint(_several(labelled.select("key", "id", F.coalesce("component", "id").alias("label"))).filter("members > 2"))

    rest = left(components(edges, "a", "b"))
    if rest.isEmpty():
        return components(edges, "a", "b") if not edges.isEmpty() else None
    ids = checkpoint(rest.select("id").distinct())
    known = traits(ids)

    some = rest.filter(F.pmod(F.xxhash64("key", "id"), F.ceil(F.col("members") / CENTRES)) == 0)
    differ = F.col("x.label") != F.col("y.label")
    new = verify(checkpoint(_across(_cells(rest, known), _cells(some, known), differ, close)))
    past, edges = edges, checkpoint(edges.unionByName(new))
    release(past, rest)

    rest = left(components(edges, "a", "b"))
    cells = _cells(rest, known, small)
    # each pair once: from the lower tile, or from the lower id of a tile
    order = (F.col("x.tile") < F.col("y.tile")) | ((F.col("x.tile") == F.col("x.other")) & (F.col("x.id") < F.col("y.id")))
    pairs = checkpoint(_across(cells, cells, differ & order, close))
    edges = checkpoint(edges.unionByName(verify(pairs)))
    return components(edges, "a", "b") if not edges.isEmpty() else None

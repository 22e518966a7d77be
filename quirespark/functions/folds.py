"""Greedy folds over arrays: the state is a few scalars and the starts of groups.

Items are never carried in the accumulator, which every step copies; groups are
cut from the array afterwards. Arrays are for texts; the rows of a book, which
may be a million, are folded as a stream (``ordered``, ``packed``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STATE = "struct<at:int,held:bigint,starts:array<int>>"


def group_starts(weights: Column, takes: Callable[[Column, Column], Column]) -> Column:
    """Positions (from 1) at which groups start; ``takes(held, x)`` says whether a
    group that holds ``held`` takes an item of weight x as well.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("held"), F.array().alias("starts")).cast(_STATE)

    def step(acc: Column, x: Column) -> Column:
        joins = (acc["at"] > 0) & takes(acc["held"], x)
        held = F.when(joins, acc["held"] + x).otherwise(x.cast("long"))
        starts = F.when(joins, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(acc["at"] + 1)))
        return F.struct((acc["at"] + 1).alias("at"), held.alias("held"), starts.alias("starts")).cast(_STATE)

    return F.aggregate(weights, start, step, lambda acc: acc["starts"])


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: within a lambda an expression is evaluated for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def cut_at(items: Column, starts: Column) -> Column:
    """The array of groups of ``items`` that begin at ``starts``."""

    def cut(x: Column, at: Column) -> Column:
        return F.transform(at, lambda s, k: F.slice(x, s, F.coalesce(F.get(at, k + 1), F.size(x) + 1) - s))

    return bind(items, lambda x: bind(starts, lambda at: cut(x, at)))


def greedy(items: Column, weight: Callable[[Column], Column], limit: int | Column) -> Column:
    """Groups in order, each of at most ``limit`` in sum; an item above it stands alone."""

    def groups(x: Column) -> Column:
        return cut_at(x, group_starts(F.transform(x, lambda i: weight(i).cast("int")), lambda held, w: held + w <= limit))

    return bind(items, groups)


def ordered(rows: DataFrame, group: str, *order: str | Column) -> DataFrame:
    """Rows with each group in one partition, in order, for functions that go through them as a stream.

    Dealt by an expression of its own, so that no join before it stands in for the exchange.
    """
    return rows.repartition(F.xxhash64(group)).sortWithinPartitions(group, *order)


def packed(rows: DataFrame, group: str, order: str, weight: str, takes: Callable[[int, int], bool]) -> DataFrame:
    """(group, order, weight, pack): the rows with the number of the pack, from 1, that each falls into.

    ``takes(held, w)`` says whether a pack that holds ``held`` takes a row of weight w
    as well. The rows stream through Python; its state is three numbers.
    """
    import pyarrow as pa

    t = rows.select(group, order, F.col(weight).cast("long").alias(weight))

    def run(batches):
        first, at, held, pack = True, None, None, 0
        for b in batches:
            out = []
            for g, w in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if first or g != at:
                    first, at, pack, held = False, g, 1, w
                elif held is not None and w is not None and takes(held, w):
                    held += w
                else:
                    pack, held = pack + 1, w
                out.append(pack)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=[*b.schema.names, "pack"])

    return ordered(t, group, order, weight).mapInArrow(run, t.schema.add("pack", "integer"))

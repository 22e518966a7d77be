"""Running sums within groups of any size, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

PART = "__part"


def deal(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Rows in ranges of (group, order), with the number of their partition in PART.

    The rows are written, as a second evaluation could deal them in another way.
    """
    return checkpoint(df.repartitionByRange(F.col(group), *order).withColumn(PART, F.spark_partition_id()))


def running(dealt: DataFrame, group: str, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Add for each ``value: name`` the sum of value over the group up to this row.

    A large group spans many partitions of ``deal``; each partition sums its own
    rows, and each (group, partition) takes the totals of the partitions before
    it. ``group`` and the values are long and not null. Rows equal in ``order``
    come in any order.
    """
    totals = dealt.groupBy(F.col(group).alias("__g"), F.col(PART).alias("__p")).agg(*[F.sum(v).alias(f"__t_{n}") for v, n in sums.items()])
    earlier = Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__g", "__p", *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__b_{n}") for n in sums.values()])
    local = Window.partitionBy(group, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.select("*", *[F.sum(v).over(local).alias(n) for v, n in sums.items()])
    out = out.join(totals, (F.col(group) == F.col("__g")) & (F.col(PART) == F.col("__p")))
    return out.select(*dealt.columns, *[(F.col(n) + F.col(f"__b_{n}")).alias(n) for n in sums.values()])


def before(df: DataFrame, group: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of ``group`` that come earlier."""
    out = running(deal(df, group, order), group, order, {value: name})
    return out.withColumn(name, F.col(name) - F.col(value)).drop(PART)

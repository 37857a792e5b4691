"""Sequence numbers and first rows within a group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.sources.scratch import cut

_RANGE, _ROW = "__range", "__row"


def rank_in_group(
    df: DataFrame,
    by: Sequence[str],
    time: str,
    ties: Sequence[str] = (),
    name: str = "ecg_order",
    ranges: int | None = None,
) -> DataFrame:
    """1, 2, 3, ... per group in (time, ties) order; rows equal in these are numbered in any order.

    Rows are dealt into ranges of (group, time, ties, place of the row) and written once when called. Numbers run
    inside a group's part of a range, shifted by the rows the group has in earlier ranges. As the place of a row is
    part of the order, one group, one instant and even equal rows are split over ranges, so no task holds more than
    one range. Rows without a key or a time are kept with a NULL number. ``ranges`` is their number (the session's
    shuffle partitions by default, merged while they are small).
    """
    by = list(by)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, time]])
    order = [*by, time, *ties, _ROW]
    placed = df.where(whole).withColumn(_ROW, F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(ranges, *order) if ranges else placed.repartitionByRange(*order)
    # Written before ranges are counted: a range keeps its number, whoever reads it.
    dealt = cut(dealt.withColumn(_RANGE, F.spark_partition_id()), "ranges")

    earlier = W.partitionBy(*by).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    sizes = dealt.groupBy(*by, _RANGE).agg(F.count("*").alias("__size"))
    shifts = sizes.select(*by, _RANGE, F.sum("__size").over(earlier).alias("__base")).where(F.col("__base") > 0)
    # Ranges are in order, so each goes on with one group of the range before at most: no more rows than ranges.
    inside = F.row_number().over(W.partitionBy(*by, _RANGE).orderBy(time, *ties, _ROW))
    numbered = dealt.withColumn("__inside", inside).join(F.broadcast(shifts), [*by, _RANGE], "left")
    number: Column = (F.coalesce("__base", F.lit(0)) + F.col("__inside")).cast("int")
    rest = df.where(~whole).select(*df.columns, F.lit(None).cast("int").alias(name))
    return numbered.select(*df.columns, number.alias(name)).unionByName(rest)


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group; each task cuts its rows to ``n`` per group before the shuffle."""
    position = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("__position", position).where(F.col("__position") <= n).drop("__position")

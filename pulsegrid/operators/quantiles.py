"""Exact, linearly interpolated quantiles and quantile bins without sorting or gathering all values.

1. equal values are counted, in each task first, so hot values collapse;
2. the (value, count) rows are dealt into ranges of (group, value) and written once;
3. the ranges' totals, a few rows per task, say which ranges hold the wanted ranks;
4. running counts inside those ranges give the values.

The work grows with the number of distinct values; no task holds more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.sources.scratch import cut

# The approximate mode merges one sketch per task in one task; this size keeps that cheap. It errs by at most
# n / APPROXIMATE ranks.
APPROXIMATE = 1_000


# Items a stored sketch keeps, and how far its ranks are off at most, as a share of all rows (well over its 99 % bound).
SKETCH_SIZE, SKETCH_ERROR = 1_000, 0.01
# Sketches of a group are merged in so many heaps first.
HEAPS = 64


def value_sketches(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` and ``sketch``, a mergeable summary of the values of ``col``; NULL and NaN are ignored.

    Build it per day or range, store it, and answer for any longer time from the sketches alone.
    """
    data = df.select(*by, F.col(col).cast("double").alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    made = data.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__x", SKETCH_SIZE).alias("sketch"))
    return made.where("n > 0")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` and ``sketch`` of all values of the sketches given: heaps first, so that no task merges all of a
    group's."""
    heap = F.pmod(F.xxhash64("sketch"), F.lit(HEAPS)).alias("__heap")
    n, merged = F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")
    heaps = sketches.groupBy(*by, heap).agg(n, merged)
    return heaps.groupBy(*by).agg(n, merged).where("n > 0")


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` and the array ``quantiles``: values whose ranks are within ``SKETCH_ERROR`` of those asked for.

    One row per row of ``sketches``; merge them first.
    """
    found = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs])
    return sketches.select(*by, "n", found.alias("quantiles"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` and the array ``quantiles`` (one per probability); NULL and NaN are ignored.

    Counts values when called: they are written below the shared folder, and the result reads them.
    """
    by = list(by)
    probs = list(probs)
    data = df.select(*by, F.col(col).cast("double").alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    counts = data.groupBy(*by, "__x").agg(F.count(F.lit(1)).alias("__rows"))
    # Written before the ranges are numbered: a range keeps its number, whoever reads it.
    counts = cut(counts.repartitionByRange(*by, "__x").withColumn("__range", F.spark_partition_id()), "value-counts")

    whole = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = whole.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    ranges = counts.groupBy(*by, "__range").agg(F.sum("__rows").alias("__total"))
    ranges = ranges.select(
        *by,
        "__range",
        "__total",
        F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"),
        F.sum("__total").over(whole).alias("n"),
    )
    places = [f"{float(p)!r}D * (n - 1)" for p in probs]
    ranks = [rank for place in places for rank in (f"floor({place})", f"least(floor({place}) + 1, n - 1)")]
    held = " or ".join(f"(__base <= {rank} and {rank} < __base + __total)" for rank in ranks) or "false"
    names = [f"__by{i}" for i in range(len(by))]
    own = [F.col(c).alias(n) for c, n in zip(by, names)]
    wanted = ranges.where(held).select(*own, F.col("__range").alias("__wanted"), "__base", "n")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)] + [F.col("__range") == F.col("__wanted")]
    inside = counts.join(wanted, same).drop("__wanted", *names)
    running = W.partitionBy(*by, "__range").orderBy("__x")
    ranked = inside.withColumn("__upto", F.col("__base") + F.sum("__rows").over(running))

    def at_rank(rank: str, name: str) -> Column:
        return F.expr(f"max(if(__upto - __rows <= {rank} and {rank} < __upto, __x, null))").alias(name)

    picks = [at_rank(rank, f"__v{i}") for i, rank in enumerate(ranks)]
    values = [
        f"if(n is null, null, __v{2 * i} + (__v{2 * i + 1} - __v{2 * i}) * ({place} - floor({place})))"
        for i, place in enumerate(places)
    ]
    found = ranked.groupBy(*by).agg(F.max("n").alias("n"), *picks)
    return found.select(*by, "n", F.expr(f"array({', '.join(values)})").alias("quantiles"))


def quantile_edges(
    df: DataFrame, col: str, q: int, exact: bool = True, decimals: int | None = None
) -> DataFrame:
    """One row with the array ``edges``: q + 1 quantiles, equal ones merged."""
    probs = [i / q for i in range(q + 1)]
    if exact:
        edges = exact_quantiles(df, col, probs).select(F.col("quantiles").alias("edges"))
    else:
        x = F.col(col).cast("double")
        edges = df.where(x.isNotNull() & ~F.isnan(x)).agg(F.percentile_approx(x, probs, APPROXIMATE).alias("edges"))
    if decimals is not None:
        edges = edges.select(F.transform("edges", lambda e: F.round(e, decimals)).alias("edges"))
    return edges.select(F.array_distinct("edges").alias("edges"))


def quantile_bin(
    df: DataFrame,
    col: str,
    q: int = 10,
    exact: bool = True,
    decimals: int | None = None,
    name: str = "bin",
) -> DataFrame:
    """Adds ``name`` (0-based), ``name_lo`` and ``name_hi``: right-closed quantile bins, lowest included.

    Rows without a value get no bin. ``decimals`` rounds edges and values before they are compared. The
    edges are a one-row scalar subquery; only the ``q + 1`` numbers travel.
    """
    edges = quantile_edges(df, col, q, exact, decimals)
    x = F.col(col).cast("double")
    x = x if decimals is None else F.round(x, decimals)
    above = " + ".join(f"int(coalesce(get(__edges, {i}) < __x, false))" for i in range(q + 1))
    number = f"if(isnan(__x), null, least(greatest({above} - 1, 0), greatest(size(__edges) - 2, 0)))"
    placed = df.withColumns({"__edges": edges.scalar(), "__x": x}).withColumn(
        name, F.expr(f"if(__x is null, null, {number})")
    )
    return placed.select(
        *df.columns,
        name,
        F.expr(f"get(__edges, `{name}`)").alias(f"{name}_lo"),
        F.expr(f"coalesce(get(__edges, `{name}` + 1), get(__edges, `{name}`))").alias(f"{name}_hi"),
    )

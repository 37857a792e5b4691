"""Histograms, hexagonal bins and density curves: counts first, so curves are computed from small tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.quantiles import exact_quantiles


def _present(*cols: str):
    keep = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        keep = keep & x.isNotNull() & ~F.isnan(x)
    return keep


def histogram(df: DataFrame, col: str, width: float = 1.0) -> DataFrame:
    """``center`` and ``n``: bins centred on multiples of ``width``, closed on the right."""
    x = F.col(col).cast("double")
    center = F.ceil(x / width - 0.5).cast("double") * width
    return df.where(_present(col)).groupBy(center.alias("center")).agg(F.count(F.lit(1)).alias("n"))


def hexbin(df: DataFrame, x: str, y: str, bins: int = 30) -> DataFrame:
    """Hexagon centres and counts, ``bins`` hexagons across each range.

    A hexagonal grid is two rectangular lattices, the second shifted by half a step both ways; a point
    belongs to the nearest centre of either.
    """
    data = df.where(_present(x, y)).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    bounds = data.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))]))
    placed = data.withColumn("b", bounds.scalar())

    def axis(c: str, stretch: float):
        """Step, origin and position in lattice units."""
        raw = (F.col(f"b.hi_{c}") - F.col(f"b.lo_{c}")) / bins
        step = F.when(raw > 0, raw).otherwise(F.lit(1.0))
        origin = F.floor(F.col(f"b.lo_{c}") / step) * step - 1e-6
        return step * stretch, origin, (F.col(c) - origin) / (step * stretch)

    x_step, x0, u = axis("x", 1.0)
    y_step, y0, v = axis("y", math.sqrt(3.0))
    placed = placed.select(
        x_step.alias("x_step"), x0.alias("x0"), u.alias("u"), y_step.alias("y_step"), y0.alias("y0"), v.alias("v")
    )
    u, v = F.col("u"), F.col("v")
    first = (F.floor(u + 0.5).cast("double"), F.floor(v + 0.5).cast("double"))
    second = (F.floor(u) + 0.5, F.floor(v) + 0.5)

    def distance(center):
        return (u - center[0]) * (u - center[0]) + 3 * (v - center[1]) * (v - center[1])

    nearer = distance(first) <= distance(second)
    return (
        placed.select(
            "x_step",
            "x0",
            "y_step",
            "y0",
            F.when(nearer, first[0]).otherwise(second[0]).alias("i"),
            F.when(nearer, first[1]).otherwise(second[1]).alias("j"),
        )
        .groupBy("i", "j", "x_step", "x0", "y_step", "y0")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            (F.col("x0") + F.col("i") * F.col("x_step")).alias("x"),
            (F.col("y0") + F.col("j") * F.col("y_step")).alias("y"),
            "n",
        )
    )


def bandwidths(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Rule-of-thumb Gaussian bandwidth per group: 0.9 min(sd, IQR / 1.34) n^(-1/5)."""
    spread = df.where(_present(col)).groupBy(*by).agg(F.stddev_samp(F.col(col).cast("double")).alias("sd"))
    quartiles = exact_quantiles(df, col, [0.25, 0.75], by=by)
    iqr = (F.get("quantiles", F.lit(1)) - F.get("quantiles", F.lit(0))) / 1.34
    width = F.coalesce(
        F.nullif(F.least("sd", iqr), F.lit(0.0)), F.nullif(F.nanvl("sd", F.lit(None)), F.lit(0.0)), F.lit(1.0)
    )
    return spread.join(quartiles, list(by)).select(*by, (0.9 * width * F.pow("n", F.lit(-0.2))).alias("h"))


def density(
    df: DataFrame,
    col: str,
    by: Sequence[str],
    grid: int = 512,
    bandwidth: float | None = None,
) -> DataFrame:
    """Gaussian kernel density per group on ``grid`` points over the common range: by, x, density.

    Each value is shared linearly between its two grid points and only these weights (at most ``grid``
    rows per group) meet the kernel.
    """
    by = list(by)
    value = F.col(col).cast("double")
    data = df.where(_present(col)).select(*by, value.alias("__x"))
    bounds = data.agg(F.struct(F.min("__x").alias("lo"), F.max("__x").alias("hi")))
    low = F.col("__range.lo")
    step = F.nullif((F.col("__range.hi") - low) / (grid - 1), F.lit(0.0))
    at = F.coalesce((F.col("__x") - low) / step, F.lit(0.0))
    cell = F.least(F.floor(at), F.lit(grid - 2).cast("long"))
    shared = (
        data.withColumn("__range", bounds.scalar())
        .select(*by, "__range", cell.alias("__cell"), (at - cell).alias("__part"))
        .groupBy(*by, "__range", "__cell")
        .agg(F.sum(1 - F.col("__part")).alias("__left"), F.sum("__part").alias("__right"))
    )
    halves = F.array(
        F.struct(F.col("__cell").alias("cell"), F.col("__left").alias("weight")),
        F.struct((F.col("__cell") + 1).alias("cell"), F.col("__right").alias("weight")),
    )
    weights = (
        shared.select(*by, "__range", F.explode(halves).alias("__half"))
        .groupBy(*by, "__range", F.col("__half.cell").alias("__cell"))
        .agg(F.sum("__half.weight").alias("__weight"))
    )
    totals = weights.groupBy(*by).agg(F.sum("__weight").alias("__total"))
    if bandwidth is None:
        weights = weights.join(bandwidths(df, col, by).withColumnRenamed("h", "__h"), by)
    else:
        weights = weights.withColumn("__h", F.lit(float(bandwidth)))
    weights = weights.join(totals, by)
    width = F.coalesce(step, F.lit(0.0))
    z = (F.col("__grid") - F.col("__cell")) * width / F.col("__h")
    kernel = F.exp(-z * z / 2) / (F.col("__h") * math.sqrt(2 * math.pi))
    return (
        weights.withColumn("__grid", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .groupBy(*by, "__grid", (low + F.col("__grid") * width).alias("x"))
        .agg(F.sum(F.col("__weight") / F.col("__total") * kernel).alias("density"))
        .drop("__grid")
    )

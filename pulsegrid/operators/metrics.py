"""Quality of predictions on scored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.functions.stats import student_p_column
from pulsegrid.sources import scratch


def _pairs(df: DataFrame, y: str, p: str, by: Sequence[str]) -> DataFrame:
    pairs = df.select(*by, F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p"))
    return pairs.where(F.col("y").isNotNull() & F.col("p").isNotNull() & ~F.isnan("y") & ~F.isnan("p"))


def pearson(df: DataFrame, x: str, y: str, p_value: bool = False) -> DataFrame:
    """One row: correlation ``r``, ``n``, ``t`` and on request the two-sided p-value."""
    stats = _pairs(df, x, y, []).agg(F.corr("y", "p").alias("r"), F.count(F.lit(1)).alias("n"))
    r, n = F.col("r"), F.col("n")
    stats = stats.withColumn("t", r * F.sqrt(F.try_divide(n - 2, 1 - r * r)))
    return stats.withColumn("p", student_p_column("t", (n - 2).cast("double"))) if p_value else stats


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    error = F.col("y") - F.col("p")
    return _pairs(df, y, pred, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae")
    )


def binary_metrics(
    df: DataFrame, y: str, p: str, by: Sequence[str] = (), thresholds: int = 200
) -> DataFrame:
    """Accuracy at 0.5, log-loss and area under the ROC curve for a 0/1 label and a score in [0, 1].

    The ROC curve is taken at ``thresholds`` evenly spaced cuts, so scores are only counted per cut
    interval: at most ``thresholds`` rows per group reach the running sum.
    """
    by = list(by)
    clipped = F.least(F.greatest(F.col("p"), F.lit(1e-7)), F.lit(1 - 1e-7))
    loss = -(F.col("y") * F.log(clipped) + (1 - F.col("y")) * F.log(1 - clipped))
    # Scores outside [0, 1] belong to the intervals at the ends.
    last = F.lit(thresholds - 1).cast("long")
    cut = F.least(F.greatest(F.ceil(F.col("p") * (thresholds - 1)), F.lit(1).cast("long")), last)
    counted = (
        _pairs(df, y, p, by)
        .groupBy(*by, cut.alias("cut"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("y").alias("pos"),
            F.sum(1 - F.col("y")).alias("neg"),
            F.sum(((F.col("p") > 0.5).cast("double") == F.col("y")).cast("double")).alias("right"),
            F.sum(loss).alias("loss"),
        )
    )
    whole = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    higher = whole.orderBy(F.desc("cut")).rowsBetween(W.unboundedPreceding, -1)
    above = F.coalesce(F.sum("pos").over(higher), F.lit(0.0))
    won = F.sum(F.col("neg") * (F.col("above") + F.col("pos") / 2))
    n = F.sum("n")
    return (
        counted.withColumn("above", above)
        .groupBy(*by)
        .agg(
            n.alias("n"),
            (F.sum("right") / n).alias("accuracy"),
            (F.sum("loss") / n).alias("log_loss"),
            F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("auc"),
        )
    )


def exact_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` and ``auc``: the share of (one, zero) pairs whose scores are in the right order, ties half.

    For scores of any range. Equal scores are counted first, in each task, then dealt into ranges of (group, score)
    and written once when called. Ranks come from running counts inside a range and the counts of earlier ranges, so no
    task holds more than one range. NULL for a group without ones or zeros.
    """
    by = list(by)
    counts = _pairs(df, y, p, by).groupBy(*by, "p").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    counts = scratch.cut(counts.repartitionByRange(*by, "p").withColumn("__range", F.spark_partition_id()), "score-counts")
    lower = W.partitionBy(*by, "__range").orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
    inside = counts.withColumn("won", F.col("pos") * (below + F.col("neg") / 2))
    ranges = inside.groupBy(*by, "__range").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "won")])
    whole = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("neg").over(whole.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    won = F.sum(F.col("won") + F.col("pos") * F.col("before"))
    return (
        ranges.withColumn("before", before)
        .groupBy(*by)
        .agg(
            (F.sum("pos") + F.sum("neg")).cast("long").alias("n"),
            F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("auc"),
        )
    )

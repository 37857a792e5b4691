"""Grouped and whole-table aggregates; all combine within tasks before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.columns import is_missing
from pulsegrid.operators.quantiles import APPROXIMATE, exact_quantiles

_NUMERIC = (T.NumericType,)


def groups_with_max(df: DataFrame, by: str, col: str, above: float) -> DataFrame:
    """Groups whose largest ``col`` exceeds ``above``, with that maximum."""
    return df.groupBy(by).agg(F.max(col).alias(f"max_{col}")).where(F.col(f"max_{col}") > above)


def keep_unique(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs exactly once, in one aggregation: any row of a group of one is that row."""
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest])
        .where(F.col("__n") == 1)
        .where(F.col(key).isNotNull())
        .select(*df.columns)
    )


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Rows per value, most frequent first; missing values are left out."""
    counted = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), F.asc(col))


def count_distinct(df: DataFrame, col: str, name: str = "n_distinct", exact: bool = True) -> DataFrame:
    counter = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(counter(F.col(col)).alias(name))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def describe(
    df: DataFrame, cols: Sequence[str] | None = None, percentiles: Sequence[float] = (0.25, 0.5, 0.75), exact: bool = True
) -> DataFrame:
    """Per numeric column: count, mean, std (sample), min, max and the percentiles (the median always).

    One row per described column. The columns are read once, as (column, value) rows.
    """
    cols = list(cols) if cols else [f.name for f in df.schema if isinstance(f.dataType, _NUMERIC)]
    probs = sorted({*percentiles, 0.5})
    names = [f"p{round(p * 100, 6):g}" for p in probs]
    values = df.select(F.explode(F.array(*[_named(c) for c in cols])).alias("cell")).select("cell.*")
    moments = [
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    ]
    # A column without values keeps its row, with a count of zero.
    values = values.withColumn("x", F.nanvl("x", F.lit(None).cast("double")))
    if exact:
        marks = exact_quantiles(values, "x", probs, by=["column"])
        table = values.groupBy("column").agg(*moments).join(marks.drop("n"), "column", "left")
    else:
        table = values.groupBy("column").agg(*moments, F.percentile_approx("x", probs, APPROXIMATE).alias("quantiles"))
    kept = [c for c in table.columns if c != "quantiles"]
    return table.select(*kept, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)])


def _named(col: str):
    return F.struct(F.lit(col).alias("column"), F.col(col).cast("double").alias("x"))


def rows_per_key(df: DataFrame, key: str, percentiles: Sequence[float] = (0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """Distribution of the number of rows per key."""
    return describe(df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")), ["n_rows"], percentiles)


def rates_by(df: DataFrame, by: str | Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Group size and mean of 0/1 or boolean flags."""
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col(f).cast("double")).alias(f"{f}_rate") for f in flags]
    )


def profile(df: DataFrame) -> DataFrame:
    """True-rate of boolean columns and missing-rate of double columns, one row per column, one pass."""
    rates: dict[str, tuple[str, object]] = {}
    for field in df.schema:
        if isinstance(field.dataType, T.BooleanType):
            rates[field.name] = ("true", F.avg(F.col(field.name).cast("double")))
        elif isinstance(field.dataType, T.DoubleType):
            rates[field.name] = ("missing", F.avg(is_missing(df, field.name).cast("double")))
    wide = df.agg(*[rate.alias(name) for name, (_, rate) in rates.items()])
    cells = [
        F.struct(F.lit(name).alias("column"), F.lit(kind).alias("kind"), F.col(name).alias("rate"))
        for name, (kind, _) in rates.items()
    ]
    return wide.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def info(df: DataFrame) -> DataFrame:
    """Column name, type and number of non-null values, one pass."""
    wide = df.agg(*[F.count(F.when(~is_missing(df, c), 1)).alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("non_null"),
        )
        for f in df.schema
    ]
    return wide.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def event_share(df: DataFrame, subject: str, event: str) -> DataFrame:
    """Share of distinct subjects with at least one row where ``event`` is 1; one row out."""
    per_subject = df.where(F.col(subject).isNotNull()).groupBy(subject).agg(
        F.max(F.coalesce((F.col(event) == 1).cast("int"), F.lit(0))).alias("hit")
    )
    return per_subject.agg(
        F.sum("hit").alias("n_event"), F.count(F.lit(1)).alias("n_subjects"), F.avg("hit").alias("share")
    )


def rows_per_source(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))

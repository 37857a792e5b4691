"""Row-wise work on tables with a ``signal`` column; nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import signal as S


def flag_bad(df: DataFrame, signal: str = "signal") -> DataFrame:
    return df.withColumns({"any_flat": S.any_flat(signal), "any_nan": S.any_nan(signal)})


def reject_bad(df: DataFrame, signal: str = "signal") -> DataFrame:
    """Recordings whose leads all have samples, no NaN or NULL, and are not constant."""
    return df.where(S.is_sound(signal))


def reject_counts(df: DataFrame, signal: str = "signal") -> DataFrame:
    """One row: recordings in all, kept, and rejected per reason (a recording can have both, or an empty lead)."""
    flat, nan = F.col("any_flat"), F.col("any_nan")
    return (
        df.select(S.any_flat(signal).alias("any_flat"), S.any_nan(signal).alias("any_nan"), S.is_sound(signal).alias("sound"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("sound"), 1)).alias("n_kept"),
            F.count(F.when(flat, 1)).alias("n_flat"),
            F.count(F.when(nan, 1)).alias("n_nan"),
        )
    )


def zscore(df: DataFrame, signal: str = "signal") -> DataFrame:
    return df.withColumn(signal, S.zscore(signal))


def quality_table(df: DataFrame, signal: str = "signal") -> DataFrame:
    """Signal replaced by mean, sd, all_zeros (some lead constant) and any_nan."""
    others = [c for c in df.columns if c != signal]
    return df.select(
        *others,
        S.signal_summary(signal).alias("__summary"),
        S.any_flat(signal).alias("all_zeros"),
        S.any_nan(signal).alias("any_nan"),
    ).select(
        *others,
        F.col("__summary.mean").alias("mean"),
        F.col("__summary.sd").alias("sd"),
        "all_zeros",
        "any_nan",
    )

"""Signal quality per recording and its roll-up over the splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.aggregates import profile, rows_per_source
from pulsegrid.operators.reshape import union_tagged
from pulsegrid.operators.signals import quality_table

SPLITS = ("train", "test", "val")


def recording_quality(recordings: DataFrame, signals: DataFrame) -> DataFrame:
    """filename, age, fs, mean, sd, all_zeros, any_nan, split: signals shrink to a few numbers before they are joined."""
    measured = quality_table(signals.select("file_name", "fs", "signal"))
    narrow = recordings.select("file_name", F.col("ecg_age").cast("double").alias("age"), "split")
    return measured.join(narrow, "file_name").select(
        F.col("file_name").alias("filename"), "age", "fs", "mean", "sd", "all_zeros", "any_nan", "split"
    )


def quality_report(quality: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(column profile over all splits, rows per split)."""
    tagged = quality.withColumnRenamed("split", "source")
    return profile(tagged), rows_per_source(tagged)

"""Train / validation / test splits that keep all rows of a subject together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import unit_hash

_BUCKETS = 4096


def group_split(
    df: DataFrame,
    key: str = "subject_id",
    test: float = 0.2,
    val: float = 0.2,
    seed: int = 42,
    mode: str = "xxhash64",
    name: str = "split",
) -> DataFrame:
    """Adds the split by hash of ``key``: no shuffle, shares hold in expectation.

    ``val`` is a share of what ``test`` leaves, so the defaults give 64 / 16 / 20 %. Rows without a key go to train.
    """
    u = unit_hash(F.col(key), seed=seed, mode=mode)
    return df.withColumn("__u", u).withColumn(
        name,
        F.when(F.col(key).isNull(), "train").when(F.col("__u") < test, "test").when(F.col("__u") < test + (1 - test) * val, "val").otherwise("train"),
    ).drop("__u")


def group_split_exact(
    df: DataFrame,
    key: str = "subject_id",
    test: float = 0.2,
    val: float = 0.2,
    seed: int = 42,
    mode: str = "xxhash64",
    name: str = "split",
) -> DataFrame:
    """As ``group_split`` with exact numbers of subjects, rounded up: ceil(test n), then ceil(val rest).

    Subjects are ranked by hash: within 4096 equal hash ranges in parallel, shifted by the sizes of the
    lower ranges (a table of at most 4096 rows, hence the broadcast). Rows without a key go to train.
    """
    keys = (
        df.select(key)
        .where(F.col(key).isNotNull())
        .distinct()
        .withColumn("u", unit_hash(F.col(key), seed=seed, mode=mode))
        .withColumn("bucket", F.floor(F.col("u") * _BUCKETS))
    )
    all_buckets = W.partitionBy(F.lit(0))
    lower = all_buckets.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = (
        keys.groupBy("bucket")
        .count()
        .select(
            "bucket",
            F.coalesce(F.sum("count").over(lower), F.lit(0)).alias("base"),
            F.sum("count").over(all_buckets).alias("n"),
        )
    )
    within = F.row_number().over(W.partitionBy("bucket").orderBy("u", key))
    n_test = F.ceil(F.lit(float(test)) * F.col("n"))
    n_val = F.ceil(F.lit(float(val)) * (F.col("n") - n_test))
    position = F.col("base") + within - 1
    assigned = keys.join(F.broadcast(sizes), "bucket").select(
        key,
        F.when(position < n_test, "test").when(position < n_test + n_val, "val").otherwise("train").alias(name),
    )
    return df.join(assigned, key, "left").withColumn(name, F.coalesce(name, F.lit("train")))


def split_leaks(df: DataFrame, key: str = "subject_id", split: str = "split") -> DataFrame:
    """Keys found in more than one split; empty for a sound split."""
    return df.groupBy(key).agg(F.count_distinct(split).alias("n_splits")).where(F.col("n_splits") > 1)


def assert_disjoint(df: DataFrame, key: str = "subject_id", split: str = "split") -> None:
    """Raise if a key is in more than one split. Runs a job."""
    leaks = split_leaks(df, key, split).limit(5).collect()
    if leaks:
        raise ValueError(f"{key} in several splits: {[row[key] for row in leaks]}")

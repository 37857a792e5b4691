"""First rows, group samples and epoch shuffles; all repeatable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import md5_key, permuted, unit_hash


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample_groups(df: DataFrame, key: str, n: int = 250, seed: int = 42, mode: str = "xxhash64") -> DataFrame:
    """All rows of ``n`` keys chosen by seeded hash; every row when there are no more than ``n`` keys."""
    chosen = (
        df.select(key)
        .where(F.col(key).isNotNull())
        .distinct()
        .orderBy(unit_hash(F.col(key), seed=seed, mode=mode), key)
        .limit(n)
    )
    return df.join(chosen, key, "left_semi")


def epoch_shuffle(df: DataFrame, key: str, seed: int = 42, epoch: int = 0, mode: str = "xxhash64") -> DataFrame:
    """All rows in an order that depends on (seed, epoch) only, by a distributed range sort."""
    if mode == "md5":
        order = md5_key(F.lit(epoch), F.col(key), seed=seed)
    else:
        order = unit_hash(F.lit(epoch), F.col(key), seed=seed, mode=mode)
    return df.withColumn("shuffle_key", order).orderBy("shuffle_key", key)


def number_shards(df: DataFrame, key: str, rows_per_shard: int = 2048, seed: int = 42, mode: str = "xxhash64") -> DataFrame:
    """Rows dealt into shards of about ``rows_per_shard`` by a hash of their unique ``key``, done once for all epochs.

    Adds ``shard`` of ``shards`` and ``shard_row`` of ``shard_rows``, both from 0. Counts the rows when called. Rows of a
    repeated key share a shard; NULL is a key like any other.
    """
    shards = F.lit(max(1, -(-df.count() // rows_per_shard))).cast("long")
    dealt = df.withColumns({"shards": shards, "shard": F.floor(unit_hash(F.col(key), seed=seed, mode=mode) * shards)})
    whole = W.partitionBy("shard")
    return dealt.withColumns(
        {"shard_row": F.row_number().over(whole.orderBy(key)).cast("long") - 1, "shard_rows": F.count(F.lit(1)).over(whole)}
    )


def epoch_order(sharded: DataFrame, seed: int = 42, epoch: int = 0, mode: str = "xxhash64") -> DataFrame:
    """Rows of ``number_shards`` with their place in an epoch: ``epoch_shard``, the turn of their shard, and
    ``epoch_row``, their turn inside it. Both are permutations worked out from the row's own numbers: nothing is sorted
    or shuffled, and a reader takes shard after shard with one shard in its buffer."""
    now = F.lit(epoch)
    return sharded.withColumns(
        {
            "epoch_shard": permuted(F.col("shard"), F.col("shards"), now, seed=seed, mode=mode),
            "epoch_row": permuted(F.col("shard_row"), F.col("shard_rows"), now, F.col("shard"), seed=seed, mode=mode),
        }
    )


def in_epoch_order(ordered: DataFrame, tasks: int) -> DataFrame:
    """Rows of ``epoch_order`` in that order, ``tasks`` partitions of equally many shards; sent once, without the sample
    a sort by ranges takes first."""
    part = F.floor(F.col("epoch_shard") * tasks / F.col("shards")).cast("int")
    return ordered.repartitionById(tasks, part).sortWithinPartitions("epoch_shard", "epoch_row")

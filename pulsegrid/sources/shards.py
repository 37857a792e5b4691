"""Feature shards: Parquet by split, bounded files, and a bucketed form for joins without a signal shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_shards(df: DataFrame, path: str, max_records: int = 512, mode: str = "errorifexists") -> None:
    """One folder per split; no file holds more than ``max_records`` rows (512 full signals are about 240 MB)."""
    df.write.mode(mode).partitionBy("split").option("maxRecordsPerFile", max_records).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, cols: Sequence[str]) -> DataFrame:
    """Only the folder of ``split`` and the columns asked for are read."""
    return spark.read.parquet(path).where(F.col("split") == split).select(*cols)


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists", path: str | None = None
) -> None:
    """Catalog table hashed by ``key``: a later join on ``key`` leaves these rows where they are. One file per bucket.
    The files go to ``path``, or to the warehouse."""
    writer = df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` written in buckets below ``path`` and read back; no catalog entry stays behind."""
    table = f"bucketed_{uuid.uuid4().hex}"
    write_bucketed(df, table, key, buckets, path=path)
    # What is read is known from here on, and dropping a table with a path of its own leaves its files.
    rows = df.sparkSession.table(table)
    rows.schema
    df.sparkSession.sql(f"drop table {table}")
    return rows

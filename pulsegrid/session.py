"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks broadcast joins from measured (not guessed)
# sizes, splits hot join partitions, and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join turns from sort-merge to hash when every partition of one side is measured to be below this, so
    # wide signal rows are not sorted to meet narrow labels; beyond it the sort-merge join stays.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "256m",
    "spark.sql.session.timeZone": "UTC",
    # Rows with a 12 x 5000 signal are about 480 kB, so Arrow batches are counted in tens of rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "pulsegrid", **extra: str) -> SparkSession:
    """Session with ``SETTINGS``; ``extra`` keys use ``__`` for dots (``spark__ui__enabled="false"``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every node sees, as the cluster names it in ``spark.checkpoint.dir``; who runs the cluster keeps it
    tidy. A local master, whose tasks share one machine, may do without: it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors and the driver share")
    return tempfile.mkdtemp(prefix="pulsegrid-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/pulsegrid/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut", path: str | None = None) -> DataFrame:
    """Write and read back: later stages restart from the files, whichever executor is lost."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

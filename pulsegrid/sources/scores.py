"""Score maps and the score store."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.sources import manifest

# One entry of a flat JSON object: a quoted integer key and a number or null.
_ENTRY = r'"(-?[0-9]+)"\s*:\s*(null|NaN|-?Infinity|[-+0-9.eE]+)'


def read_score_map(spark: SparkSession, path: str, key: str = "study_id", value: str = "age_pred") -> DataFrame:
    """Rows of flat JSON objects ``{"<id>": <number>, ...}``.

    Such a file is often one object on one line. It is read as text cut at commas, which Spark can split
    over tasks, so no task ever holds a whole object. NaN and null come out as NULL.
    """
    pieces = spark.read.option("lineSep", ",").text(path)
    entries = pieces.select(F.explode(F.regexp_extract_all("value", F.lit(_ENTRY), F.lit(0))).alias("entry"))
    raw = F.regexp_extract("entry", _ENTRY, 2)
    score = F.when(~raw.isin("null", "NaN"), raw).cast("double")
    return entries.select(F.regexp_extract("entry", _ENTRY, 1).cast("long").alias(key), score.alias(value))


def write_score_map(df: DataFrame, path: str, key: str = "study_id", value: str = "age_pred", ids_per_object: int = 1000) -> None:
    """Flat JSON objects, one per line, each for a range of ``ids_per_object`` ids (``key`` is unique)."""
    entry = F.concat(F.lit('"'), F.col(key).cast("string"), F.lit('": '), F.coalesce(F.col(value).cast("string"), F.lit("null")))
    objects = df.groupBy(F.floor(F.col(key) / ids_per_object)).agg(F.array_join(F.collect_list(entry), ", ").alias("body"))
    objects.select(F.concat(F.lit("{"), "body", F.lit("}"))).write.text(path)


def find_duplicates(scores: DataFrame, key: str = "study_id") -> DataFrame:
    """(key, model, version) scored more than once."""
    return scores.groupBy(key, "model", "version").count().where(F.col("count") > 1).drop("count")


def write_scores(scores: DataFrame, path: str, mode: str = "append", key: str = "study_id") -> None:
    """Add to the store at ``path``, one row per (key, model, version).

    ``append`` adds what the store lacks; ``overwrite`` replaces the model versions that ``scores`` has, and no
    others. Rows of one (key, model, version) within ``scores`` become one, of the greatest score. The rows go to a
    folder of their own, and then a manifest, written last and under a number no other has, makes them part of the
    store: what a failed or repeated append leaves behind is never read. If another writer was first with that number,
    the rows are held against the new state of the store and written again.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode}")
    spark = scores.sparkSession
    keys = [key, "model", "version"]
    one_each = scores.groupBy(*keys).agg(F.max("score").alias("score"))
    while True:
        number, state = manifest.latest(spark, path)
        new = one_each
        if mode == "append":
            new = new.join(_rows(spark, path, state, key).select(*keys), keys, "left_anti")
        batch = uuid.uuid4().hex
        new.write.partitionBy("model", "version").parquet(f"{path}/data/batch={batch}")
        dropped = state["dropped"]
        if mode == "overwrite":
            written = _rows(spark, path, {"batches": [batch], "dropped": []}, key)
            parts = written.select("model", "version").distinct().collect()
            # A pair for each model version that is replaced and each folder before.
            dropped = dropped + [[old, r.model, r.version] for r in parts for old in state["batches"] if [old, r.model, r.version] not in dropped]
        if manifest.commit(spark, path, number + 1, {"batches": [*state["batches"], batch], "dropped": dropped}):
            return


def read_scores(spark: SparkSession, path: str, key: str = "study_id") -> DataFrame:
    """What the latest manifest of the store lists: ``key``, ``score``, ``model``, ``version``."""
    return _rows(spark, path, manifest.latest(spark, path)[1], key)


def _rows(spark: SparkSession, path: str, state: dict, key: str) -> DataFrame:
    schema = f"{key} long, score double, batch string, model string, version string"
    if not state["batches"]:
        return spark.createDataFrame([], schema).drop("batch")
    reader = spark.read.schema(schema).option("basePath", f"{path}/data")
    rows = reader.parquet(*[f"{path}/data/batch={b}" for b in state["batches"]])
    if state["dropped"]:
        # Folder names, so whole folders are left out.
        rows = rows.where(~F.struct("batch", "model", "version").isin(*[F.struct(*map(F.lit, d)) for d in state["dropped"]]))
    return rows.drop("batch")

"""Batch model scoring: the one place where rows go to Python workers, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.signal import flatten_signal
from pulsegrid.operators.joins import pending
from pulsegrid.operators.membership import key_filter, maybe_in
from pulsegrid.sources.scratch import cut


@dataclass(frozen=True)
class Model:
    """``make_predict`` is called once per Python worker and returns batch array -> scores."""

    version: str
    make_predict: Callable
    n_values: int
    batch_size: int = 512


def score_columns(models: Mapping[str, Model], signal: str = "signal", todo: str | None = None) -> Column:
    """Struct with one score per model; the models see lead-major float32 rows of ``n_values`` samples.

    All models sit in one function, so a recording goes to Python once however many models there are. Each model
    gets its rows in chunks of its own ``batch_size``; with ``todo``, an array column of model names, only the rows
    that name it, and the other rows have no score of it.
    """
    sizes = {m.n_values for m in models.values()}
    if len(sizes) != 1:
        raise ValueError(f"models differ in input size: {sorted(sizes)}")
    specs = [(name, m.make_predict, m.batch_size) for name, m in models.items()]

    def make_predict():
        predictors = [(make(), size) for _, make, size in specs]

        def predict(batch: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
            made = {}
            for k, ((name, _, _), (run, size)) in enumerate(zip(specs, predictors)):
                rows = np.flatnonzero(wanted.reshape(len(batch), -1)[:, k] > 0)
                made[name] = np.full(len(batch), np.nan)
                for start in range(0, len(rows), size):
                    own = rows[start : start + size]
                    made[name][own] = np.asarray(run(batch[own]), dtype="float64")
            return made

        return predict

    predict = predict_batch_udf(
        make_predict,
        return_type=T.StructType([T.StructField(name, T.DoubleType()) for name in models]),
        batch_size=max(m.batch_size for m in models.values()),
        input_tensor_shapes=[[sizes.pop()], [len(specs)]],
    )
    names = [F.lit(1.0) if todo is None else F.array_contains(todo, name).cast("double") for name in models]
    return predict(flatten_signal(signal).cast("array<float>"), F.array(*[n.cast("float") for n in names]))


def score(df: DataFrame, model: Model, signal: str = "signal", name: str = "score") -> DataFrame:
    """Adds ``name`` and drops the signal. Reject bad recordings first: all rows need ``n_values`` samples."""
    return df.withColumn(name, score_columns({"score": model}, signal)["score"]).drop(signal)


def score_all(
    signals: DataFrame, models: Mapping[str, Model], done: DataFrame, key: str = "study_id", signal: str = "signal"
) -> DataFrame:
    """Rows (key, model, version, score) for what ``done`` lacks, reading each signal once for all models.

    The pending models of each recording are a narrow table, written once when this is called. A Bloom filter of its
    keys is tested where signals are read, so unwanted signals go no further, and only then do they meet that table:
    signals stored in buckets by ``key`` (``sources.shards.write_bucketed``) stay where they are. A model only sees the
    recordings it has not scored.
    """
    todo = (
        pending(signals.select(key), done, {name: m.version for name, m in models.items()}, key)
        .groupBy(key)
        .agg(F.collect_set("model").alias("__todo"))
    )
    todo = cut(todo, "pending")
    wanted = maybe_in(signals.select(key, signal), key, *key_filter(todo, key)).join(todo, key)
    scored = wanted.select(key, "__todo", score_columns(models, signal, "__todo").alias("__scores"))
    scored = scored.select(key, "__todo", *[F.col("__scores")[name].alias(name) for name in models])
    # Unpivoting keeps the scores below it evaluated once; exploding an array of them would infer a filter on
    # the array and score every recording a second time.
    rows = scored.unpivot([key, "__todo"], list(models), "model", "score")
    versions = F.create_map(*[F.lit(text) for name, m in models.items() for text in (name, m.version)])
    return rows.where(F.array_contains("__todo", F.col("model"))).select(
        key, "model", versions[F.col("model")].alias("version"), "score"
    )

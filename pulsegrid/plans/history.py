"""Training histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.functions.columns import parse_model_name
from pulsegrid.operators.reshape import unpivot_metrics
from pulsegrid.schemas import HISTORY
from pulsegrid.sources.tables import read_many


def read_histories(spark: SparkSession, glob: str) -> DataFrame:
    """``<model>-history.csv`` files, whatever metric columns each has, with model, arch and task."""
    return parse_model_name(read_many(spark, glob, HISTORY, origin="model", by_name=True), "model")


def loss_curves(histories: DataFrame) -> DataFrame:
    """model, task, epoch, name (loss or val_loss), value."""
    return unpivot_metrics(histories, ["model", "task", "epoch"], ["loss", "val_loss"])


def history_report(spark: SparkSession, glob: str) -> DataFrame:
    return loss_curves(read_histories(spark, glob))

"""Feature rows and the task views over them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import signal as S
from pulsegrid.functions.columns import cap_filter, drop_missing, encode_binary
from pulsegrid.operators.joins import attach_labels
from pulsegrid.operators.signals import reject_bad, zscore
from pulsegrid.schemas import LAB_LABELS


def build_features(
    recordings: DataFrame,
    signals: DataFrame,
    labs: DataFrame,
    stays: DataFrame,
    labels: Sequence[str] = LAB_LABELS,
) -> DataFrame:
    """One row per sound recording: standardised signal, demographics, labels; absent labels are NULL.

    All narrow joins come first. The signal table, nearly all of the bytes, is rejected and scaled where it
    is read and meets the narrow rows once. Under the settings of ``session`` that is a broadcast join while
    the narrow rows are measured to be small, then a hash join that leaves signals unsorted; stored bucketed
    by ``file_name`` they are not shuffled either.
    """
    narrow = attach_labels(recordings, labs, stays).select(
        "file_name",
        "split",
        F.col("ecg_age").cast("double").alias("age"),
        encode_binary("gender").alias("gender"),
        F.col("gender").isNotNull().alias("gender_known"),
        *[c for label in labels for c in (label, f"{label}_offset")],
        "hospital_expire_flag",
        "icu_expire_flag",
        "ecg_offset",
    )
    scaled = zscore(reject_bad(signals.select("file_name", "signal")))
    return scaled.join(narrow, "file_name")


@dataclass(frozen=True)
class Task:
    """What a training reader takes from the feature rows."""

    label: str
    inputs: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    max_label: float | None = None
    noise: bool = False
    batch_size: int = 64


# The readers of each experiment.
TASKS = {
    "cnn-age": Task("age", required=("age",), max_label=90.0),
    "cnn-gender": Task("gender"),
    "cnn-potassium": Task("potassium", required=("potassium",)),
    "cnn-sodium": Task("sodium", required=("sodium",)),
    "resnet-age": Task("age", required=("age",), max_label=90.0),
    "resnet-age2": Task("age", inputs=("gender",), required=("age",), max_label=90.0, noise=True),
    "resnet-gender": Task("gender"),
    "resnet-potassium": Task("potassium", required=("potassium",)),
    "resnet-sodium": Task("sodium", required=("sodium",)),
    "tl-age-mort": Task("icu_expire_flag", inputs=("age", "gender"), required=("icu_expire_flag", "age")),
    "tl-age-sex": Task("gender"),
    "transformer-gender": Task("gender", batch_size=16),
    "transformer-age": Task("age", required=("age",), max_label=90.0),
    "transformer-age1": Task("age", required=("age",), max_label=90.0, batch_size=8),
    "transformer-age2": Task("age", required=("age",), max_label=90.0, batch_size=8),
    "transformer-age3": Task("age", required=("age",), max_label=90.0, batch_size=8),
}


def task_view(
    features: DataFrame,
    task: Task | str,
    training: bool = False,
    seed: int = 42,
    epoch: int = 0,
    max_label: float | None = None,
    noise_mode: str = "xxhash64",
) -> DataFrame:
    """``file_name``, ``signal``, the extra inputs and ``label``, with the filters of the task.

    ``training=True`` adds noise where the task asks for it, another for each ``seed`` and ``epoch``; ``noise_mode`` is the
    hash it is made from. ``max_label`` sets an inclusive bound for a
    task without one.
    """
    task = TASKS[task] if isinstance(task, str) else task
    rows = drop_missing(features, task.required)
    bound = task.max_label if max_label is None else max_label
    if bound is not None:
        rows = cap_filter(rows, task.label, bound, inclusive=True)
    signal = F.col("signal")
    if task.noise and training:
        signal = S.augment_noise("signal", "file_name", seed=seed, epoch=epoch, mode=noise_mode)
    return rows.select(
        "file_name", signal.alias("signal"), *task.inputs, F.col(task.label).cast("double").alias("label")
    )

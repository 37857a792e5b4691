"""Label tables and the split recording table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.columns import anchored_age, icu_expire_flag, offset
from pulsegrid.operators.aggregates import keep_unique
from pulsegrid.operators.joins import interval_join, lookup
from pulsegrid.operators.nearest import nearest_in_window
from pulsegrid.operators.ranking import first_per_group
from pulsegrid.operators.splitting import group_split
from pulsegrid.schemas import LAB_ITEM_IDS, LAB_LABELS

# Search windows of the two extracts.
LAB_WINDOW = timedelta(hours=4)
STAY_BEFORE = timedelta(hours=8)
STAY_AFTER = timedelta(hours=24)


def _labelled(labevents: DataFrame, d_labitems: DataFrame, items: Sequence[int]) -> DataFrame:
    """Results of the wanted items with their label (NULL where the dimension lacks the item).

    A handful of items covers all rows, so a shuffle by item would put everything in a few tasks. The dimension
    is cut to the items asked for and to one row of each (the first label), so what gets broadcast has at most
    ``len(items)`` rows and no result is doubled, whatever the dimension holds.
    """
    wanted = F.col("itemid").isin(*items)
    dimension = first_per_group(d_labitems.where(wanted), ["itemid"], [F.col("label").asc_nulls_last()])
    return labevents.where(wanted).join(F.broadcast(dimension), "itemid", "left")


def lab_pairs(
    records: DataFrame, labevents: DataFrame, d_labitems: DataFrame, items: Sequence[int] = LAB_ITEM_IDS
) -> DataFrame:
    """Every (recording, result) pair of one patient within four hours, with label and offset.

    The extract itself. Label tables do not need it: see ``lab_labels``.
    """
    results = _labelled(labevents, d_labitems, items)
    windows = records.select("subject_id", "study_id", "ecg_time")
    pairs = interval_join(results, windows, ["subject_id"], "charttime", "ecg_time", LAB_WINDOW, LAB_WINDOW)
    return pairs.withColumn("offset", offset("charttime", "ecg_time"))


def nearest_labs(
    records: DataFrame,
    labevents: DataFrame,
    d_labitems: DataFrame,
    conditions: Mapping[str, Column],
    items: Sequence[int] = LAB_ITEM_IDS,
) -> DataFrame:
    """Per recording and condition (on label and value) a struct with the nearest result within four hours."""
    return nearest_in_window(
        records.select("subject_id", "study_id", "ecg_time"),
        _labelled(labevents, d_labitems, items),
        ["subject_id"],
        "ecg_time",
        "charttime",
        LAB_WINDOW,
        LAB_WINDOW,
        conditions,
        payload=["valuenum"],
        ties=["labevent_id"],
    )


def lab_labels(
    records: DataFrame,
    labevents: DataFrame,
    d_labitems: DataFrame,
    labels: Sequence[str] = LAB_LABELS,
    coherent: bool = True,
) -> DataFrame:
    """``study_id``, ``<label>``, ``<label>_offset`` (minutes) for recordings with any labelled result in reach.

    ``coherent`` as in ``nearest_value``: value and offset from one result, or each from its own nearest.
    """
    of_label = {name: F.lower("label") == name for name in labels}
    valued = F.col("valuenum").isNotNull()
    conditions = {name: of_label[name] & valued for name in labels}
    if coherent:
        seen = ["any"]
        conditions["any"] = F.col("label").isNotNull()
    else:
        seen = [f"{name}_any" for name in labels]
        conditions.update({f"{name}_any": of_label[name] for name in labels})
    near = nearest_labs(records, labevents, d_labitems, conditions)
    columns = []
    for name in labels:
        timed = name if coherent else f"{name}_any"
        columns.append(F.col(name)["valuenum"].alias(name))
        columns.append(offset(F.col(timed)["charttime"], "ecg_time").alias(f"{name}_offset"))
    return near.where(F.coalesce(*seen).isNotNull()).select("study_id", *columns)


def stay_recordings(records: DataFrame, stays: DataFrame) -> DataFrame:
    """Recordings from eight hours before to a day after an ICU admission of the patient, one row per stay."""
    points = records.select("subject_id", "study_id", "ecg_time")
    return interval_join(points, stays, ["subject_id"], "ecg_time", "icu_intime", STAY_BEFORE, STAY_AFTER)


def first_recordings(records: DataFrame, stays: DataFrame) -> DataFrame:
    """Stays with their first recording, for stays that have one.

    Number one of a stay is the nearest recording at or after the start of its window, so it is looked up
    without pairing stays and recordings.
    """
    started = stays.withColumn("__start", F.col("icu_intime") - F.lit(STAY_BEFORE))
    found = nearest_in_window(
        started,
        records.select("subject_id", "study_id", "ecg_time"),
        ["subject_id"],
        "__start",
        "ecg_time",
        timedelta(0),
        STAY_BEFORE + STAY_AFTER,
        {"first": F.lit(True)},
        payload=[],
        ties=["study_id"],
    )
    return found.where(F.col("first").isNotNull()).select(
        *stays.columns, F.col("first")["study_id"].alias("study_id"), F.col("first")["ecg_time"].alias("ecg_time")
    )


def hosp_labels(records: DataFrame, stays: DataFrame) -> DataFrame:
    """Outcome flags and offset (minutes) per recording that is first in exactly one stay."""
    flagged = first_recordings(records, stays).select(
        "study_id",
        "hadm_id",
        "hospital_expire_flag",
        icu_expire_flag().alias("icu_expire_flag"),
        offset("ecg_time", "icu_intime").alias("ecg_offset"),
    )
    return keep_unique(flagged, "study_id")


def with_demographics(records: DataFrame, patients: DataFrame) -> DataFrame:
    """Recordings with gender and the patient's age at recording, NULL for unknown patients."""
    return lookup(records, patients, "subject_id").withColumn("ecg_age", anchored_age())


def split_recordings(records: DataFrame, patients: DataFrame, seed: int = 42, mode: str = "xxhash64") -> DataFrame:
    return group_split(with_demographics(records, patients), "subject_id", seed=seed, mode=mode)

"""Explicit schemas of the input tables: no inference pass over large files."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "time": T.TimestampNTZType(),
}


def schema(**columns: str) -> T.StructType:
    """``schema(subject_id="long", ecg_time="time")``."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


RECORD_LIST = schema(subject_id="long", study_id="long", file_name="long", path="string", ecg_time="time")

PATIENTS = schema(subject_id="long", gender="string", anchor_age="int", anchor_year="int")

LABEVENTS = schema(
    subject_id="long", charttime="time", itemid="long", valuenum="double", valueuom="string", labevent_id="long"
)

D_LABITEMS = schema(itemid="long", label="string")

ICUSTAY_DETAIL = schema(
    subject_id="long",
    hadm_id="long",
    stay_id="long",
    gender="string",
    admission_age="double",
    admittime="time",
    dischtime="time",
    icu_intime="time",
    icu_outtime="time",
    hospital_expire_flag="int",
)

SIGNALS = T.StructType(
    [
        T.StructField("file_name", T.LongType()),
        T.StructField("fs", T.IntegerType()),
        T.StructField("lead_names", T.ArrayType(T.StringType())),
        T.StructField("signal", T.ArrayType(T.ArrayType(T.DoubleType()))),
    ]
)

# Columns every training history shares; metric columns differ by task and read as NULL where absent.
HISTORY = schema(
    epoch="int",
    loss="double",
    val_loss="double",
    mse="double",
    val_mse="double",
    mae="double",
    val_mae="double",
    accuracy="double",
    val_accuracy="double",
    auc="double",
    val_auc="double",
)

# Laboratory items of the label extract, and the labels carried by feature rows.
LAB_ITEM_IDS = (51002, 52642, 50971, 52610, 50983, 52623)
LAB_LABELS = ("troponin i", "potassium", "sodium")

# Lead order of a 12-lead recording.
LEAD_NAMES = ("I", "II", "III", "aVR", "aVF", "aVL", "V1", "V2", "V3", "V4", "V5", "V6")

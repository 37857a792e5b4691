"""End-to-end jobs on hand-made rows, plan shape, and hot keys."""

import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import cohort, features, outcomes, quality
from pulsegrid.schemas import ICUSTAY_DETAIL
from pulsegrid.sources import shards
from tests.helpers import at, plan_of, rows

RECORDS = "subject_id long, study_id long, file_name long, ecg_time timestamp_ntz"


def stay(subject, stay_id, intime, out_hours=10.0, disch_hours=20.0, died=0, age=60.0, gender="M"):
    out = None if out_hours is None else at(hours=intime + out_hours)
    return (subject, 100 + stay_id, stay_id, gender, age, at(hours=intime - 5), at(hours=intime + disch_hours),
            at(hours=intime), out, died)


@pytest.fixture(scope="module")
def tables(spark):
    stays = [
        stay(1, 1, 0, died=1, out_hours=20.0),
        stay(1, 2, 10),                       # overlaps stay 1: study 12 can be first in both
        stay(2, 3, 0, out_hours=None),
        stay(3, 4, 0),                        # no recording
    ]
    records = [
        (1, 11, 11, at(hours=-8)),            # exactly at the early end of stay 1
        (1, 12, 12, at(hours=3)),             # stay 1 second, stay 2 first (7 hours before)
        (2, 21, 21, at(hours=24)),            # exactly at the late end
        (2, 22, 22, at(hours=24)),            # same instant, larger id
        (9, 91, 91, at()),                    # unknown patient
    ]
    patients = [(1, "M", 50, 2020), (2, "F", 95, 2024)]
    return {
        "stays": spark.createDataFrame(stays, ICUSTAY_DETAIL),
        "records": spark.createDataFrame(records, RECORDS),
        "patients": spark.createDataFrame(patients, "subject_id long, gender string, anchor_age int, anchor_year int"),
    }


def test_hospital_labels(tables):
    joined = cohort.stay_recordings(tables["records"], tables["stays"])
    assert rows(joined, "stay_id", "study_id") == [(1, 11), (1, 12), (2, 12), (3, 21), (3, 22)]
    out = cohort.hosp_labels(tables["records"], tables["stays"])
    assert rows(out, "study_id", "hadm_id", "hospital_expire_flag", "icu_expire_flag", "ecg_offset") == [
        (11, 101, 1, 1, -480.0), (12, 102, 0, 0, -420.0), (21, 103, 0, 0, 1440.0),
    ]


def test_a_study_first_in_two_stays_is_left_out(spark, tables):
    later = tables["records"].where("study_id <> 11")
    assert rows(cohort.hosp_labels(later, tables["stays"]), "study_id") == [(21,)]


def test_split_table_keeps_unknown_patients(tables):
    out = cohort.split_recordings(tables["records"], tables["patients"])
    assert rows(out, "study_id", "ecg_age") == [(11, 54), (12, 54), (21, 95), (22, 95), (91, None)]


SIGNALS = {11: [[1.0, 2.0], [3.0, 5.0]], 12: [[1.0, 1.0], [3.0, 5.0]], 21: [[0.0, 4.0], [1.0, -1.0]],
           22: [[float("nan"), 1.0], [2.0, 3.0]], 91: [[2.0, 1.0], [0.0, 9.0]]}


@pytest.fixture(scope="module")
def feature_rows(spark, tables):
    signals = spark.createDataFrame([(k, 500, v) for k, v in SIGNALS.items()], "file_name long, fs int, signal array<array<double>>")
    labs = spark.createDataFrame(
        [(11, 4.5, 3.0), (21, None, 1.0)], "study_id long, potassium double, potassium_offset double"
    )
    labs = labs.selectExpr("*", *[f"cast(null as double) as `{n}{s}`" for n in ("sodium", "troponin i") for s in ("", "_offset")])
    stays = cohort.hosp_labels(tables["records"], tables["stays"])
    return features.build_features(
        cohort.split_recordings(tables["records"], tables["patients"]), signals, labs, stays
    )


def test_feature_rows(feature_rows):
    out = {r.file_name: r for r in feature_rows.collect()}
    assert sorted(out) == [11, 21, 91]
    assert out[11].signal == [[-1.0, 1.0], [-1.0, 1.0]]
    assert (out[11].gender, out[11].age, out[11].potassium, out[11].icu_expire_flag) == (1, 54.0, 4.5, 1)
    assert (out[91].gender, out[91].gender_known, out[91].age, out[91].potassium) == (0, False, None, None)
    assert out[91]["troponin i"] is None


def test_task_views(feature_rows):
    assert rows(features.task_view(feature_rows, "cnn-age"), "file_name", "label") == [(11, 54.0)]
    assert rows(features.task_view(feature_rows, "cnn-gender"), "file_name", "label") == [(11, 1.0), (21, 0.0), (91, 0.0)]
    assert rows(features.task_view(feature_rows, "cnn-potassium"), "file_name") == [(11,)]
    assert rows(features.task_view(feature_rows, "cnn-potassium", max_label=4.0)) == []
    death = features.task_view(feature_rows, "tl-age-mort")
    assert death.columns == ["file_name", "signal", "age", "gender", "label"]
    assert rows(death, "file_name", "age", "gender", "label") == [(11, 54.0, 1, 1.0), (21, 95.0, 0, 0.0)]
    quiet = features.task_view(feature_rows, "resnet-age2").first().signal
    noisy = features.task_view(feature_rows, "resnet-age2", training=True).first().signal
    assert quiet != noisy and abs(quiet[0][0] - noisy[0][0]) <= 0.5
    epochs = [
        features.task_view(feature_rows, "resnet-age2", training=True, epoch=e, noise_mode=mode).first().signal
        for e, mode in ((1, "md5"), (1, "md5"), (2, "md5"), (1, "xxhash64"))
    ]
    assert epochs[0] == epochs[1] and len({str(e) for e in epochs}) == 3
    assert all(abs(a - b) <= 0.5 for e in epochs for x, y in zip(e, quiet) for a, b in zip(x, y))
    assert features.task_view(feature_rows, "cnn-age", training=True).first().signal == features.task_view(feature_rows, "cnn-age").first().signal
    assert set(features.TASKS) >= {"resnet-sodium", "transformer-age3", "tl-age-sex"}


@pytest.fixture
def nothing_is_small(spark):
    """Rule out broadcasts, as with tables beyond the threshold."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def signal_join(plan):
    """The part of an executed plan from the join with the signals downwards."""
    return plan[plan.index("ShuffledHashJoin [file_name"):]


def test_signals_meet_labels_without_a_sort(feature_rows, nothing_is_small):
    stream = signal_join(plan_of(feature_rows.select("*"), executed=True)).splitlines()
    side = [line for line in stream[: next(i for i, line in enumerate(stream) if "Scan" in line)]]
    assert not any("Sort" in line for line in side)


def test_bucketed_signals_are_not_shuffled(spark, tables, nothing_is_small):
    signals = spark.createDataFrame([(k, 500, v) for k, v in SIGNALS.items()], "file_name long, fs int, signal array<array<double>>")
    shards.write_bucketed(signals, "bucketed_signals", "file_name", 4)
    try:
        recordings = cohort.split_recordings(tables["records"], tables["patients"])
        labs = spark.createDataFrame([(11, 4.5, 3.0)], "study_id long, potassium double, potassium_offset double")
        stays = cohort.hosp_labels(tables["records"], tables["stays"])
        out = features.build_features(recordings, spark.table("bucketed_signals"), labs, stays, labels=["potassium"])
        stream = signal_join(plan_of(out, executed=True))
        side = stream[: stream.index("FileScan")]
        assert "Exchange" not in side and "Sort" not in side
        assert "Bucketed: true" in stream[len(side): len(side) + 400]
        assert rows(out, "file_name") == [(11,), (21,), (91,)]
    finally:
        spark.sql("drop table bucketed_signals")


def test_quality_report(spark, tables):
    signals = spark.createDataFrame([(k, 500, v) for k, v in SIGNALS.items()], "file_name long, fs int, signal array<array<double>>")
    table = quality.recording_quality(cohort.split_recordings(tables["records"], tables["patients"]), signals)
    assert table.columns == ["filename", "age", "fs", "mean", "sd", "all_zeros", "any_nan", "split"]
    profile, sizes = quality.quality_report(table)
    assert rows(profile) == [
        ("age", "missing", 0.2), ("all_zeros", "true", 0.2), ("any_nan", "true", 0.2), ("mean", "missing", 0.2), ("sd", "missing", 0.2),
    ]
    assert sum(n for _, n in rows(sizes)) == 5


def test_age_mortality(spark, tables):
    scores = spark.createDataFrame([(11, 70.0), (12, 50.0)], "study_id long, age_pred double")
    out = outcomes.age_mortality(tables["records"], tables["stays"], scores, q=2)
    # Study 21 has no score: no bin. Errors are 10 (died in ICU) and -10.
    assert rows(out, "bin", "n", "hospital_expire_flag_rate", "icu_mort_rate") == [(0, 1, 0.0, 0.0), (1, 1, 1.0, 1.0)]
    strict = tables["stays"].withColumn("admission_age", F.lit(90.0))
    assert rows(outcomes.age_mortality(tables["records"], strict, scores, q=2)) == []


def test_age_over_time(spark, tables):
    scores = spark.createDataFrame([(11, 70.0), (12, 50.0)], "study_id long, age_pred double")
    out = outcomes.age_over_time(tables["records"], tables["stays"], scores)
    assert rows(out, "stay_id", "study_id", "ecg_delta", "age_delta") == [
        (1, 11, -8.0, 10.0), (1, 12, 3.0, -10.0), (3, 21, 24.0, None), (3, 22, 24.0, None),
    ]
    assert outcomes.age_over_time(tables["records"], tables["stays"], scores, n_stays=1).select("stay_id").distinct().count() == 1


def test_a_subject_with_a_third_of_all_rows(spark):
    """Hot patient with many stays and recordings: same result as the plain SQL."""
    records = spark.range(1500).selectExpr(
        "if(id % 3 = 0, 1, id) as subject_id", "id as study_id", "id as file_name",
        "timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, cast(id * 37 % 20000 as int), 0) as ecg_time",
    )
    stays = spark.range(300).selectExpr(
        "if(id % 3 = 0, 1, id) as subject_id", "id as stay_id", "id as hadm_id", "1 as hospital_expire_flag",
        "timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, cast(id * 61 % 20000 as int), 0) as icu_intime",
        "timestamp_ntz'2024-03-09' as icu_outtime", "timestamp_ntz'2024-03-05' as dischtime",
    )
    records.createOrReplaceTempView("hot_records")
    stays.createOrReplaceTempView("hot_stays")
    expected = spark.sql(
        """select stay_id, study_id, row_number() over (partition by stay_id order by ecg_time, study_id) as ecg_order
        from hot_records r join hot_stays s on r.subject_id = s.subject_id
          and ecg_time between icu_intime - interval 8 hour and icu_intime + interval 24 hour"""
    )
    from pulsegrid.operators.ranking import rank_in_group

    got = rank_in_group(cohort.stay_recordings(records, stays), ["stay_id"], "ecg_time", ["study_id"])
    assert rows(got, "stay_id", "study_id", "ecg_order") == rows(expected)
    firsts = rows(expected.where("ecg_order = 1"), "stay_id", "study_id")
    assert rows(cohort.first_recordings(records, stays), "stay_id", "study_id") == firsts

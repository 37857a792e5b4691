"""Nearest-in-window against brute force, including hot keys and repeated stamps."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.nearest import nearest_in_window, nearest_value
from pulsegrid.operators.reshape import labels_wide
from pulsegrid.plans.cohort import lab_labels, lab_pairs
from tests.helpers import at, plan_of, rows

POINTS = "subject_id long, study_id long, ecg_time timestamp_ntz"
EVENTS = "subject_id long, charttime timestamp_ntz, valuenum double, labevent_id long"


def brute(points, events, before, after):
    """{study: (labevent_id, value)} of the nearest event with a value."""
    found = {}
    for subject, study, t in points:
        best = None
        for s, c, v, i in events:
            if s == subject and v is not None and t - before <= c <= t + after:
                key = (abs(c - t), c, i)
                if best is None or key < best[0]:
                    best = (key, (i, v))
        found[study] = best and best[1]
    return found


def run(spark, points, events, before, after, **kwargs):
    out = nearest_in_window(
        spark.createDataFrame(points, POINTS),
        spark.createDataFrame(events, EVENTS),
        ["subject_id"],
        "ecg_time",
        "charttime",
        before,
        after,
        {"lab": F.col("valuenum").isNotNull()},
        payload=["valuenum"],
        ties=["labevent_id"],
        **kwargs,
    )
    assert out.columns == ["subject_id", "study_id", "ecg_time", "lab"]
    return {r.study_id: r.lab and (r.lab.labevent_id, r.lab.valuenum) for r in out.collect()}


def sample(seed, n_points, n_events, subjects, span_minutes, step_seconds):
    rng = random.Random(seed)
    steps = span_minutes * 60 // step_seconds

    def stamp():
        return at(seconds=rng.randrange(steps) * step_seconds)

    points = [(rng.choice(subjects), i, stamp()) for i in range(n_points)]
    events = [
        (rng.choice(subjects), stamp(), None if rng.random() < 0.2 else float(rng.randrange(50)), i)
        for i in range(n_events)
    ]
    return points, events


@pytest.mark.parametrize(
    "width", [timedelta(seconds=7), timedelta(minutes=1), timedelta(minutes=45), timedelta(days=1)]
)
@pytest.mark.parametrize(
    "before, after",
    [
        (timedelta(minutes=10), timedelta(minutes=10)),
        (timedelta(minutes=8), timedelta(minutes=24)),
        (timedelta(0), timedelta(minutes=3)),
    ],
)
def test_matches_brute_force(spark, before, after, width):
    # Coarse stamps make equal times and equal distances common; subject 1 holds most rows.
    points, events = sample(3, 120, 150, [1, 1, 1, 2, 3], 180, 30)
    assert run(spark, points, events, before, after, bin_width=width) == brute(points, events, before, after)


def test_window_ends_are_included(spark):
    four = timedelta(hours=4)
    micro = timedelta(microseconds=1)
    points = [(s, s, at()) for s in (1, 2, 3, 4)]
    events = [
        (1, at() - four, 1.0, 1),
        (2, at() - four - micro, 1.0, 2),
        (3, at() + four, 1.0, 3),
        (4, at() + four + micro, 1.0, 4),
    ]
    assert run(spark, points, events, four, four) == {1: (1, 1.0), 2: None, 3: (3, 1.0), 4: None}


def test_ties_go_to_the_earlier_event_then_the_smaller_id(spark):
    hour = timedelta(hours=1)
    points = [(1, 1, at())]
    events = [(1, at(minutes=5), 1.0, 1), (1, at(minutes=-5), 2.0, 9), (1, at(minutes=-5), 3.0, 8)]
    assert run(spark, points, events, hour, hour) == {1: (8, 3.0)}


def test_points_without_time_or_events_are_kept(spark):
    hour = timedelta(hours=1)
    points = [(1, 1, None), (None, 2, at()), (3, 3, at())]
    assert run(spark, points, [(1, at(), 1.0, 1)], hour, hour) == {1: None, 2: None, 3: None}


def test_one_subject_and_one_stamp_with_a_third_of_all_rows(spark):
    """Thousands of points and events of one patient at one instant would make millions of pairs."""
    hour = timedelta(hours=1)
    points = [(1, i, at()) for i in range(3000)] + [(s, s, at(minutes=s)) for s in range(5000, 5200)]
    events = [(1, at(seconds=1), float(i), i) for i in range(3000)] + [
        (s, at(minutes=s + 1), 0.5, s) for s in range(5000, 5200)
    ]
    out = run(spark, points, events, hour, hour)
    assert len(out) == len(points)
    assert {out[i] for i in range(3000)} == {(0, 0.0)}
    assert {out[s] for s in range(5000, 5200)} == {(s, 0.5) for s in range(5000, 5200)}


def test_any_partitioning_gives_the_same(spark):
    points, events = sample(8, 80, 80, [1, 2], 60, 10)
    p, e = spark.createDataFrame(points, POINTS), spark.createDataFrame(events, EVENTS)
    args = (["subject_id"], "ecg_time", "charttime", timedelta(minutes=5), timedelta(minutes=5))
    cond = {"lab": F.col("valuenum").isNotNull()}

    def result(n):
        return rows(nearest_in_window(p.repartition(n), e.repartition(n), *args, cond, ["valuenum"], ["labevent_id"]))

    assert result(1) == result(17)


PAIRS = "study_id long, label string, valuenum double, offset double, charttime timestamp_ntz, labevent_id long"


def test_value_and_offset_from_one_row_or_each_on_its_own(spark):
    pairs = spark.createDataFrame(
        [
            (1, "Potassium", None, 1.0, at(minutes=1), 1),
            (1, "Potassium", 5.0, -9.0, at(minutes=-9), 2),
            (2, "Potassium", None, 3.0, at(minutes=3), 3),
            (3, "Potassium", 7.0, 2.0, at(minutes=2), 4),
            (3, "Potassium", 6.0, -2.0, at(minutes=-2), 5),
        ],
        PAIRS,
    )
    keys = ["study_id", "label"]
    together = rows(nearest_value(pairs, keys), "study_id", "valuenum", "offset")
    apart = rows(nearest_value(pairs, keys, coherent=False), "study_id", "valuenum", "offset")
    assert together == [(1, 5.0, -9.0), (2, None, None), (3, 6.0, -2.0)]
    assert apart == [(1, 5.0, 1.0), (2, None, 3.0), (3, 6.0, -2.0)]


@pytest.mark.parametrize("coherent", [True, False])
def test_label_table_equals_the_one_from_pairs(spark, coherent):
    rng = random.Random(5)
    records = spark.createDataFrame(
        [(rng.choice([1, 1, 2, 3]), i, i, at(minutes=rng.randrange(900))) for i in range(60)],
        "subject_id long, study_id long, file_name long, ecg_time timestamp_ntz",
    )
    items = [50971, 52610, 50983, 51002, 99999, 52642]
    labevents = spark.createDataFrame(
        [
            (rng.choice([1, 1, 2, 3, 4]), at(minutes=rng.randrange(900)), rng.choice(items),
             None if rng.random() < 0.3 else float(i), "u", i)
            for i in range(200)
        ],
        "subject_id long, charttime timestamp_ntz, itemid long, valuenum double, valueuom string, labevent_id long",
    )
    # 52642 has no row: its results carry no label and must not appear.
    dimension = spark.createDataFrame(
        [(50971, "Potassium"), (52610, "Potassium"), (50983, "Sodium"), (51002, "Troponin I")],
        "itemid long, label string",
    )
    pairs = lab_pairs(records, labevents, dimension)
    assert pairs.where("label is null").count() > 0
    expected = rows(labels_wide(pairs, coherent=coherent))
    assert expected and rows(lab_labels(records, labevents, dimension, coherent=coherent)) == expected


def test_nearest_forms_no_pairs(spark):
    """The plan joins on exact keys only; no range condition is left to a join."""
    points, events = sample(8, 10, 10, [1, 2], 60, 10)
    out = nearest_in_window(
        spark.createDataFrame(points, POINTS),
        spark.createDataFrame(events, EVENTS),
        ["subject_id"],
        "ecg_time",
        "charttime",
        timedelta(minutes=5),
        timedelta(minutes=5),
        {"lab": F.col("valuenum").isNotNull()},
        ["valuenum"],
    )
    plan = plan_of(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # Values join their times, and results their points.
    assert plan.count("Join") == 2


def test_only_whole_numbers_run_through_the_timeline(spark):
    """Aggregates all work by hash, and values are fetched after the windows."""
    points, events = sample(8, 10, 10, [1, 2], 60, 10)
    hour = timedelta(hours=1)
    out = nearest_in_window(
        spark.createDataFrame(points, POINTS),
        spark.createDataFrame(events, EVENTS),
        ["subject_id"],
        "ecg_time",
        "charttime",
        hour,
        hour,
        {"lab": F.col("valuenum").isNotNull(), "any": F.lit(True)},
        ["valuenum"],
        ["labevent_id"],
    )
    plan = plan_of(out)
    assert "SortAggregate" not in plan and plan.count("HashAggregate") >= 6
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("valuenum" not in line and "labevent_id" not in line for line in windows)


def test_payload_of_any_type_and_ties_without_a_value(spark):
    hour = timedelta(hours=1)
    events = spark.createDataFrame(
        [(1, at(minutes=1), "b", 4, None), (1, at(minutes=1), "a", 4, 2), (1, at(minutes=1), "z", 5, 1), (2, at(minutes=2), "x", None, 7), (2, at(minutes=2), "y", 1, 1)],
        "subject_id long, charttime timestamp_ntz, unit string, labevent_id long, rank int",
    )
    points = spark.createDataFrame([(1, 1, at()), (2, 2, at()), (3, 3, at())], POINTS)
    args = (["subject_id"], "ecg_time", "charttime", hour, hour, {"hit": F.lit(True)})
    text = nearest_in_window(points, events, *args, ["unit"], ["labevent_id"])
    assert {r.study_id: r.hit and (r.hit.labevent_id, r.hit.unit) for r in text.collect()} == {1: (4, "a"), 2: (None, "x"), 3: None}
    numbers = nearest_in_window(points, events, *args, ["labevent_id"], ["rank"])
    assert {r.study_id: r.hit and (r.hit["rank"], r.hit.labevent_id) for r in numbers.collect()} == {1: (None, 4), 2: (1, 1), 3: None}


def test_many_points_share_one_event(spark):
    """Every point of a hot key chooses the same event; its values are fetched once."""
    day = timedelta(days=1)
    points = [(1, i, at(seconds=i)) for i in range(4000)]
    out = run(spark, points, [(1, at(seconds=-5), 7.0, 3), (1, at(seconds=-6), 8.0, 1)], day, day)
    assert len(out) == 4000 and set(out.values()) == {(3, 7.0)}


def test_lookup_names_must_be_new(spark):
    points, events = spark.createDataFrame([], POINTS), spark.createDataFrame([], EVENTS)
    day = timedelta(days=1)
    with pytest.raises(ValueError, match="study_id"):
        nearest_in_window(points, events, ["subject_id"], "ecg_time", "charttime", day, day, {"study_id": F.lit(True)}, [])

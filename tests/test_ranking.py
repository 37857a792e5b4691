import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsegrid.operators.aggregates import groups_with_max, keep_unique
from pulsegrid.operators.ranking import first_per_group, rank_in_group
from tests.helpers import at, plan_of, rows

SCHEMA = "stay_id long, study_id long, ecg_time timestamp_ntz"


def recordings(n=300, seed=2):
    rng = random.Random(seed)
    return [(rng.choice([1, 1, 1, 2, 3]), i, at(seconds=20 * rng.randrange(200))) for i in range(n)]


@pytest.mark.parametrize("ranges", [None, 1, 7, 40])
@pytest.mark.parametrize("parts", [1, 17])
def test_rank_equals_a_plain_window(spark, ranges, parts):
    df = spark.createDataFrame(recordings(), SCHEMA).repartition(parts)
    plain = df.withColumn(
        "ecg_order", F.row_number().over(W.partitionBy("stay_id").orderBy("ecg_time", "study_id")).cast("int")
    )
    assert rows(rank_in_group(df, ["stay_id"], "ecg_time", ["study_id"], ranges=ranges)) == rows(plain)


def test_rank_splits_a_hot_group(spark):
    df = spark.createDataFrame(recordings(5), SCHEMA)
    plan = plan_of(rank_in_group(df, ["stay_id"], "ecg_time", ["study_id"]))
    numbering = [line for line in plan.splitlines() if "row_number" in line and "Window [" in line]
    assert numbering and all("__range" in line for line in numbering)


@pytest.mark.parametrize("ties", [["study_id"], []])
def test_one_group_and_instant_is_numbered_by_all_tasks(spark, ties):
    """Two million rows that no key, no time and, without ties, nothing but their place tells apart."""
    n, ranges = 2_000_000, 16
    df = spark.range(n).select(F.lit(1).cast("long").alias("stay_id"), F.col("id").alias("study_id"), F.lit(at()).alias("ecg_time"))
    ranked = rank_in_group(df, ["stay_id"], "ecg_time", ties, ranges=ranges)
    numbers = ranked.agg(F.min("ecg_order"), F.max("ecg_order"), F.countDistinct("ecg_order"), F.sum((F.col("ecg_order") != F.col("study_id") + 1).cast("int"))).first()
    assert tuple(numbers)[:3] == (1, n, n) and (not ties or numbers[3] == 0)
    files = ranked.inputFiles()
    per_range = spark.read.parquet(*files).groupBy("__range").count().collect()
    assert len(per_range) == ranges and max(r["count"] for r in per_range) < 2 * n / ranges


def test_rank_keeps_rows_without_time(spark):
    df = spark.createDataFrame([(1, 1, at()), (1, 2, None)], SCHEMA)
    assert rows(rank_in_group(df, ["stay_id"], "ecg_time"), "study_id", "ecg_order") == [(1, 1), (2, None)]


def test_first_per_group_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(recordings(), SCHEMA)
    first = first_per_group(df, ["stay_id"], ["ecg_time", "study_id"])
    best = {}
    for stay, study, t in recordings():
        best[stay] = min(best.get(stay, (t, study)), (t, study))
    assert rows(first, "stay_id", "study_id") == sorted((s, v[1]) for s, v in best.items())
    plan = plan_of(first)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_unique_keys_only(spark):
    df = spark.createDataFrame([(1, 1, at()), (2, 1, at()), (3, 2, at()), (4, None, at())], SCHEMA)
    assert rows(keep_unique(df, "study_id"), "stay_id", "study_id") == [(3, 2)]


def test_groups_above_a_maximum(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, 5)], "stay_id long, ecg_order int")
    assert rows(groups_with_max(df, "stay_id", "ecg_order", 5)) == [(1, 6)]

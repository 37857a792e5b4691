import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.operators import quantiles
from pulsegrid.operators.aggregates import describe
from tests.helpers import plan_of, rows

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.98, 1.0]


def quantiles_of(df, **kwargs):
    return quantiles.exact_quantiles(df, "x", PROBS, **kwargs).collect()


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


@given(st.lists(st.integers(-30, 30) | st.floats(-1e6, 1e6), min_size=1, max_size=40))
@settings(max_examples=8, deadline=None)
def test_equal_to_linear_interpolation(spark, values):
    (row,) = quantiles_of(frame(spark, values))
    assert row.n == len(values)
    np.testing.assert_allclose(row.quantiles, np.quantile(np.array(values, float), PROBS), rtol=1e-12, atol=1e-9)


def test_nan_and_null_do_not_count(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    (row,) = quantiles_of(df)
    assert row.n == 2 and row.quantiles[3] == 2.0


def test_no_values(spark):
    (row,) = quantiles_of(frame(spark, []))
    assert row.n is None and row.quantiles == [None] * len(PROBS)


@pytest.mark.parametrize("kind", ["spread", "ties", "heavy tail"])
def test_many_values_are_exact(spark, kind):
    """Ranks fall into other ranges, and several into one."""
    base = spark.range(0, 400_000, numPartitions=7)
    u = F.rand(5)
    x = {"spread": u * 1000, "ties": F.floor(u * 9).cast("double"), "heavy tail": F.pow(1 - u, F.lit(-3.0))}[kind]
    path_free = base.select(x.alias("x")).toPandas()
    df = spark.createDataFrame(path_free).repartition(5)
    (row,) = quantiles_of(df)
    np.testing.assert_allclose(row.quantiles, np.quantile(path_free["x"], PROBS), rtol=1e-12)


def test_grouped(spark):
    rng = random.Random(4)
    data = [(rng.choice("aab"), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, x double")
    df = df.union(spark.createDataFrame([(None, 1.0), (None, 3.0)], "g string, x double"))
    got = {r.g: r.quantiles for r in quantiles_of(df, by=["g"])}
    for g in "ab":
        np.testing.assert_allclose(got[g], np.quantile([x for k, x in data if k == g], PROBS), rtol=1e-12)
    assert got[None][3] == 2.0


def test_no_task_holds_all_values(spark):
    df = spark.range(0, 20_000, numPartitions=8).select((F.col("id") * 37 % 20_000).cast("double").alias("x"))
    plan = plan_of(quantiles.exact_quantiles(df, "x", PROBS))
    assert "percentile" not in plan and "raise_error" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("q", [1, 5, 10])
def test_bins_equal_pandas(spark, q):
    rng = random.Random(q)
    values = [round(rng.gauss(0, 10), 1) for _ in range(333)] + [None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    got = [r.bin for r in quantiles.quantile_bin(df, "x", q).orderBy("i").collect()]
    expected = pd.qcut(pd.Series(values), q, labels=False, duplicates="drop")
    assert got == [None if pd.isna(b) else int(b) for b in expected]


def test_equal_edges_collapse(spark):
    values = [1.0] * 50 + [2.0, 3.0, 4.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    got = quantiles.quantile_bin(df, "x", 5).orderBy("i").collect()
    expected = pd.qcut(pd.Series(values), 5, labels=False, duplicates="drop")
    assert [r.bin for r in got] == [int(b) for b in expected]
    one = quantiles.quantile_bin(frame(spark, [7.0, 7.0]), "x", 4).collect()
    assert [(r.bin, r.bin_lo, r.bin_hi) for r in one] == [(0, 7.0, 7.0)] * 2


def test_approximate_mode_has_one_aggregate(spark):
    plan = plan_of(quantiles.quantile_bin(frame(spark, range(100)), "x", 10, exact=False))
    assert "percentile_approx" in plan and "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_describe_equals_pandas(spark):
    rng = random.Random(9)
    data = pd.DataFrame({"a": [rng.random() for _ in range(101)], "b": [rng.randrange(5) for _ in range(101)]})
    data.loc[3, "a"] = None
    got = {r["column"]: r for r in describe(spark.createDataFrame(data), percentiles=[0.2, 0.99]).collect()}
    want = data.describe(percentiles=[0.2, 0.5, 0.99])
    for column in "ab":
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max"),
                             ("p20", "20%"), ("p50", "50%"), ("p99", "99%")):
            assert got[column][ours] == pytest.approx(want[column][theirs], rel=1e-12)


def test_describe_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = {r["column"]: r for r in describe(df).collect()}
    assert got["b"]["count"] == 0 and got["b"]["p50"] is None and got["a"]["p50"] == 1.5


def test_describe_approximate(spark):
    df = frame(spark, range(1001))
    assert rows(describe(df, ["x"], exact=False), "count", "p50") == [(1001, 500.0)]


def test_sketches_merge_within_their_bound(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1, 60_000), rng.integers(0, 5, 40_000).astype(float), rng.exponential(50, 60_000)])
    frame_ = pd.DataFrame({"day": rng.integers(0, 300, len(values)), "x": values})
    df = spark.createDataFrame(frame_).withColumn("x", F.expr("if(day = 7, null, x)"))
    values = np.sort(frame_.x[frame_.day != 7].to_numpy())
    stored = quantiles.value_sketches(df, "x", ["day"])
    assert stored.count() == 299
    (row,) = quantiles.sketch_quantiles(quantiles.merge_sketches(stored), PROBS).collect()
    assert row.n == len(values)
    for p, q in zip(PROBS, row.quantiles, strict=True):
        lo, hi = np.searchsorted(values, q, "left") / len(values), np.searchsorted(values, q, "right") / len(values)
        assert lo - quantiles.SKETCH_ERROR <= p <= hi + quantiles.SKETCH_ERROR
    parts = quantiles.merge_sketches(stored.withColumn("week", F.expr("day div 7")), ["week"])
    assert parts.count() == 43 and quantiles.sketch_quantiles(quantiles.merge_sketches(parts), [0.5]).first().n == len(values)


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (1, float("nan"))], "day int, x double")
    for by in ([], ["day"]):
        stored = quantiles.value_sketches(df, "x", by)
        assert stored.count() == 0 and quantiles.sketch_quantiles(quantiles.merge_sketches(stored, by), [0.5], by).count() == 0

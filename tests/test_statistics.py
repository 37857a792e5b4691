import math
import random

import numpy as np
import pandas as pd
import pytest

from pulsegrid.functions.stats import student_p
from pulsegrid.operators import aggregates as A
from pulsegrid.operators import bins, metrics
from tests.helpers import rows


def test_student_p_values():
    # Fixed values from closed forms: t with 1 and 2 degrees of freedom.
    for t in (0.0, 0.5, 3.0, 40.0):
        assert student_p(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-9)
        assert student_p(-t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-8)
    assert math.isnan(student_p(1.0, 0))


def test_pearson(spark):
    rng = random.Random(1)
    data = [(x, x + rng.gauss(0, 2)) for x in range(30)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in data] + [(1.0, None)], "x double, y double")
    (row,) = metrics.pearson(df, "x", "y", p_value=True).collect()
    r = np.corrcoef(*zip(*data))[0, 1]
    assert row.n == 30 and row.r == pytest.approx(r)
    assert row.t == pytest.approx(r * math.sqrt(28 / (1 - r * r))) and 0 <= row.p < 1e-6


def brute_auc(y, p, thresholds=200):
    cuts = [-1e-7] + [i / (thresholds - 1) for i in range(1, thresholds - 1)] + [1 + 1e-7]
    points = [(np.mean(p[y == 0] > c), np.mean(p[y == 1] > c)) for c in cuts]
    return sum((a[0] - b[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


def test_binary_metrics(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 500)
    p = np.clip(rng.random(500) * 0.7 + 0.3 * y, 0, 1)
    p[:3] = [0.0, 1.0, 0.5]
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)] + [(None, 0.5), (1, None)], "y int, p double")
    (row,) = metrics.binary_metrics(df, "y", "p").collect()
    c = np.clip(p, 1e-7, 1 - 1e-7)
    assert row.n == 500
    assert row.accuracy == pytest.approx(np.mean((p > 0.5) == y))
    assert row.log_loss == pytest.approx(np.mean(-(y * np.log(c) + (1 - y) * np.log(1 - c))))
    assert row.auc == pytest.approx(brute_auc(y, p), rel=1e-12)


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, p double")
    assert metrics.binary_metrics(df, "y", "p").collect()[0].auc is None


@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_auc_counts_pairs_in_order(spark, by):
    rng = np.random.default_rng(4)
    data = [(int(rng.integers(3)), int(rng.integers(2)), float(rng.integers(-30, 400))) for _ in range(400)]
    df = spark.createDataFrame([*data, (0, None, 1.0), (1, 1, None), (9, 1, 5.0)], "g int, y int, p double")
    got = {tuple(r[c] for c in by): (r.n, r.auc) for r in metrics.exact_auc(df, "y", "p", by).collect()}
    groups = {(9,): [(1, 5.0)]} if by else {(): [(1, 5.0)]}
    for g, y, p in data:
        groups.setdefault((g,) if by else (), []).append((y, p))
    for key, own in groups.items():
        ones, zeros = ([p for y, p in own if y == k] for k in (1, 0))
        won = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
        want = won / len(ones) / len(zeros) if ones and zeros else None
        assert got[key][0] == len(own) and got[key][1] == (want and pytest.approx(want))
    assert len(got) == len(groups)


def test_scores_beyond_one_stay_in_the_outer_intervals(spark):
    df = spark.createDataFrame([(1, 50.0), (0, -3.0), (1, 0.7), (0, 0.2)], "y int, p double")
    assert metrics.binary_metrics(df, "y", "p").first().auc == 1.0


def test_regression_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 3.0), ("a", 2.0, 2.0), ("b", 0.0, None)], "g string, y double, p double")
    assert rows(metrics.regression_metrics(df, "y", "p", ["g"])) == [("a", 2, 2.0, 1.0)]


def test_histogram_is_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 0.6, 1.5, 1.51, None, float("nan"))], "x double")
    assert rows(bins.histogram(df, "x", 1.0)) == [(0.0, 1), (1.0, 2), (2.0, 1)]


def test_hexbin_takes_the_nearest_centre_and_keeps_every_point(spark):
    rng = random.Random(7)
    points = [(rng.random() * 10, rng.random() * 4) for _ in range(400)]
    out = bins.hexbin(spark.createDataFrame(points, "x double, y double"), "x", "y", 12).collect()
    assert sum(r.n for r in out) == len(points)
    xs, ys = zip(*points)
    dx, dy = (max(xs) - min(xs)) / 12, (max(ys) - min(ys)) / 12
    # Every point has one of the occupied centres within the reach of a hexagon.
    for x, y in points:
        d = min(((x - r.x) / dx) ** 2 + ((y - r.y) / dy) ** 2 for r in out)
        assert d <= 1 / 3 + 1e-9


def test_hexbin_of_equal_points(spark):
    df = spark.createDataFrame([(2.0, 3.0)] * 5, "x double, y double")
    assert [r.n for r in bins.hexbin(df, "x", "y").collect()] == [5]


def test_density_is_a_kernel_estimate(spark):
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(0, 1, 400), "b": rng.normal(3, 2, 250)}
    df = spark.createDataFrame([(g, float(x)) for g, v in data.items() for x in v], "g string, x double")
    out = bins.density(df, "x", ["g"]).toPandas()
    for g, v in data.items():
        curve = out[out.g == g].sort_values("x")
        iqr = np.subtract(*np.quantile(v, [0.75, 0.25]))
        h = 0.9 * min(np.std(v, ddof=1), iqr / 1.34) * len(v) ** -0.2
        exact = np.exp(-(((curve.x.to_numpy()[:, None] - v) / h) ** 2) / 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
        assert len(curve) == 512
        np.testing.assert_allclose(curve.density, exact, atol=2e-3 * exact.max())


def test_density_of_one_value(spark):
    df = spark.createDataFrame([("a", 2.0)] * 3, "g string, x double")
    out = bins.density(df, "x", ["g"], grid=4).collect()
    assert all(r.x == 2.0 and math.isfinite(r.density) for r in out)


def test_counts_and_shares(spark):
    df = spark.createDataFrame(
        [(1, "F", 1), (1, "F", 0), (2, "M", 0), (3, None, None)], "subject_id long, gender string, died int"
    )
    assert [tuple(r) for r in A.value_counts(df, "gender").collect()] == [("F", 2), ("M", 1)]
    assert rows(A.event_share(df, "subject_id", "died")) == [(1, 3, pytest.approx(1 / 3))]
    assert rows(A.count_distinct(df, "subject_id")) == [(3,)]
    assert rows(A.distinct_rows(df, ["subject_id", "gender"])) == [(1, "F"), (2, "M"), (3, None)]
    assert rows(A.rates_by(df, "gender", ["died"])) == [("F", 2, 0.5), ("M", 1, 0.0), (None, 1, None)]


def test_profile_and_info(spark):
    df = spark.createDataFrame(
        [(1, True, 1.0), (2, False, float("nan")), (3, True, None), (None, True, 2.0)], "i int, flag boolean, x double"
    )
    assert rows(A.profile(df)) == [("flag", "true", 0.75), ("x", "missing", 0.5)]
    assert rows(A.info(df)) == [("flag", "boolean", 4), ("i", "int", 3), ("x", "double", 2)]


def test_rows_per_key(spark):
    keys = [1, 1, 1, 2, 2, 3]
    df = spark.createDataFrame([(k,) for k in keys], "subject_id long")
    (row,) = A.rows_per_key(df, "subject_id").collect()
    want = pd.Series(keys).value_counts().describe(percentiles=[0.2, 0.4, 0.6, 0.8])
    assert (row["count"], row["mean"], row["p20"], row["p80"]) == pytest.approx(
        (want["count"], want["mean"], want["20%"], want["80%"])
    )

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import signal as S
from pulsegrid.operators import scoring, signals
from tests.helpers import plan_of, rows

NAN = float("nan")
SCHEMA = "study_id long, signal array<array<double>>"
DATA = {
    1: [[1.0, 2.0, 4.0], [0.5, -0.5, 3.0]],
    2: [[1.0, 1.0, 1.0], [0.5, -0.5, 3.0]],
    3: [[1.0, NAN, 1.0], [0.5, -0.5, 3.0]],
    4: [[NAN, NAN, NAN], [2.0, 2.0, 2.0]],
}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(list(DATA.items()), SCHEMA)


def test_flags_treat_nan_as_equal_to_nothing(df):
    flagged = signals.flag_bad(df)
    assert rows(flagged, "study_id", "any_flat", "any_nan") == [
        (1, False, False), (2, True, False), (3, False, True), (4, True, True),
    ]
    assert rows(signals.reject_bad(df), "study_id") == [(1,)]
    assert rows(signals.reject_counts(df)) == [(4, 1, 2, 2)]


def test_lead_statistics_equal_numpy(df):
    out = df.select("study_id", F.posexplode(S.lead_stats("signal")).alias("lead", "s")).collect()
    for r in out:
        lead = np.array(DATA[r.study_id][r.lead])
        want = [lead.min(), lead.max(), lead.mean(), lead.std()]
        np.testing.assert_allclose([r.s["min"], r.s["max"], r.s["mean"], r.s["sd"]], want, rtol=1e-12)
        assert r.s.flat == bool(lead.min() == lead.max())


def test_summary_and_zscore_equal_numpy(df):
    for r in df.select("study_id", S.signal_summary("signal").alias("s"), S.zscore("signal").alias("z")).collect():
        whole = np.array(DATA[r.study_id])
        np.testing.assert_allclose([r.s.mean, r.s.sd], [whole.mean(), whole.std()], rtol=1e-12)
        if r.study_id == 1:
            np.testing.assert_allclose(r.z, (whole - whole.mean(1, keepdims=True)) / whole.std(1, keepdims=True))
        if r.study_id == 2:
            assert r.z[0] == [None] * 3


def test_empty_signals(spark):
    df = spark.createDataFrame([(1, [[], []]), (2, [])], SCHEMA)
    out = df.select(S.lead_stats("signal").alias("l"), S.signal_summary("signal").alias("s"), S.to_time_major("signal").alias("t"))
    for r in out.collect():
        assert r.s.mean is None and r.t == [] and all(x["mean"] is None for x in r.l)
    assert rows(signals.reject_counts(df)) == [(2, 0, 0, 0)] and signals.reject_bad(df).count() == 0


def test_missing_samples_are_as_bad_as_nan(spark):
    df = spark.createDataFrame([(1, [[1.0, None, 3.0], [1.0, 2.0, 3.0]]), (2, [[None, None], [1.0, 2.0]]), (3, [[1.0, 2.0], [2.0, 1.0]])], SCHEMA)
    assert rows(signals.flag_bad(df), "study_id", "any_flat", "any_nan") == [(1, False, True), (2, False, True), (3, False, False)]
    assert rows(signals.reject_bad(df), "study_id") == [(3,)] and rows(signals.reject_counts(df)) == [(3, 1, 0, 2)]
    for r in signals.quality_table(df).collect():
        assert r.any_nan == np.isnan(r["mean"]) == np.isnan(r["sd"]) == (r.study_id < 3)


def test_reshape_and_transpose(df):
    one = df.where("study_id = 1").select(
        S.flatten_signal("signal").alias("flat"),
        S.reshape(S.flatten_signal("signal"), 2).alias("back"),
        S.to_time_major("signal").alias("turned"),
    ).first()
    assert one.flat == DATA[1][0] + DATA[1][1] and one.back == DATA[1]
    assert one.turned == [list(c) for c in zip(*DATA[1])]


def test_noise_is_repeatable_and_bounded(df):
    def noise(epoch, frame=df):
        noisy = frame.where("study_id = 1").select(S.augment_noise("signal", "study_id", epoch=epoch)).first()[0]
        return np.array(noisy) - np.array(DATA[1])

    assert np.abs(noise(0)).max() <= 0.5
    np.testing.assert_array_equal(noise(0), noise(0, df.repartition(5)))
    assert not np.array_equal(noise(0), noise(1)) and len(np.unique(noise(0))) == 6


def test_explode(df):
    out = S.explode_signal(df.where("study_id = 1"), ["study_id"], lead_names=["I", "II"])
    assert rows(out)[0] == (1, 0, "I", 0, 1.0) and out.count() == 6


def test_long_signals_take_linear_time(spark):
    """12 x 5000 samples per row: an aggregate evaluated per sample would need hours."""
    wide = spark.range(0, 16, numPartitions=8).select(
        F.col("id").alias("study_id"),
        F.transform(
            F.sequence(F.lit(0), F.lit(11)),
            lambda lead: F.transform(F.sequence(F.lit(0), F.lit(4999)), lambda i: F.sin(i * (lead + 1) + F.col("id"))),
        ).alias("signal"),
    )
    scaled = signals.zscore(signals.reject_bad(wide))
    out = scaled.select(S.signal_summary("signal").alias("s"), S.to_time_major("signal").alias("t")).select("s.*", F.size("t"))
    for mean, sd, samples in out.collect():
        assert abs(mean) < 1e-9 and sd == pytest.approx(1.0) and samples == 5000


def linear(weight):
    def make():
        def predict(batch):
            return batch.astype(np.float64).sum(axis=1) * weight

        return predict

    return make


def test_score_batches(spark, df):
    model = scoring.Model("1", linear(2.0), n_values=6, batch_size=4)
    sound = signals.reject_bad(df)
    out = scoring.score(sound, model)
    assert out.columns == ["study_id", "score"]
    assert rows(out) == [(1, pytest.approx(2 * np.sum(DATA[1])))]
    assert "ArrowEvalPython" in plan_of(out)


def test_score_all_reads_once_and_skips_what_is_done(spark):
    data = spark.createDataFrame([(i, [[float(i), 1.0], [2.0, 3.0]]) for i in range(20)], SCHEMA)
    models = {"a": scoring.Model("1", linear(1.0), 4), "b": scoring.Model("2", linear(10.0), 4)}
    done = spark.createDataFrame(
        [(i, "a", "1") for i in range(10)] + [(i, "b", "1") for i in range(20)] + [(0, "b", "2")],
        "study_id long, model string, version string",
    )
    out = scoring.score_all(data, models, done)
    got = {(r.study_id, r.model, r.version): r.score for r in out.collect()}
    want = {(i, "a", "1"): i + 6.0 for i in range(10, 20)}
    want.update({(i, "b", "2"): 10 * (i + 6.0) for i in range(1, 20)})
    assert got == want
    plan = plan_of(out, executed=True)
    assert plan.count("ArrowEvalPython") == 1
    with pytest.raises(ValueError, match="input size"):
        scoring.score_all(data, models | {"c": scoring.Model("1", linear(1.0), 5)}, done)


def test_only_scoring_uses_python(df):
    plan = plan_of(signals.quality_table(signals.zscore(df)))
    assert "Python" not in plan and "Exchange" not in plan
    assert math.isfinite(rows(signals.quality_table(df.where("study_id = 1")), "mean")[0][0])

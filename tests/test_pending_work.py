"""Rows without a key stay in the table, and models see only what is pending."""

import os

import numpy as np
import pytest

from pulsegrid.operators import membership, scoring, splitting
from pulsegrid.sources import manifest, scores, shards
from tests.helpers import plan_of, rows


def test_rows_without_a_key_go_to_train(spark):
    df = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(70)], "study_id long, subject_id long")
    for split in (splitting.group_split(df), splitting.group_split(df, mode="md5"), splitting.group_split_exact(df)):
        made = split.collect()
        assert len(made) == 70 and {r.split for r in made} <= {"train", "val", "test"}
        assert {r.split for r in made if r.subject_id is None} == {"train"}
        assert rows(splitting.split_leaks(split)) == []


def _model(folder, name, step, batch_size):
    def make_predict():
        def predict(batch):
            with open(os.path.join(folder, name), "a") as file:
                file.write(f"{len(batch)}\n")
            return np.asarray(batch).sum(axis=1) * step

        return predict

    return scoring.Model("1", make_predict, 4, batch_size)


def test_finished_models_are_not_run_again(spark, tmp_path):
    models = {"a": _model(str(tmp_path), "a", 1.0, 3), "b": _model(str(tmp_path), "b", 2.0, 5), "c": _model(str(tmp_path), "c", 3.0, 2)}
    signals = spark.createDataFrame([(i, [[1.0, 2.0], [3.0, float(i)]]) for i in range(20)], "study_id long, signal array<array<double>>").coalesce(1)
    done = spark.createDataFrame([(i, "a", "1") for i in range(20)] + [(i, "b", "1") for i in range(15)], "study_id long, model string, version string")
    got = scoring.score_all(signals, models, done).collect()
    assert sorted((r.study_id, r.model, r.score) for r in got) == sorted([(i, "b", 2.0 * (6 + i)) for i in range(15, 20)] + [(i, "c", 3.0 * (6 + i)) for i in range(20)])
    calls = {name: [int(x) for x in (tmp_path / name).read_text().split()] for name in "bc"}
    assert not (tmp_path / "a").exists() and sum(calls["b"]) == 5 and sum(calls["c"]) == 20
    assert max(calls["b"]) <= 5 and max(calls["c"]) <= 2


def _scores(spark, *rows):
    return spark.createDataFrame(list(rows), "study_id long, score double, model string, version string")


def test_writing_scores_twice_doubles_nothing(spark, tmp_path):
    made = _scores(spark, (1, 0.5, "a", "1"), (2, 0.25, "a", "1"))
    path = str(tmp_path / "store")
    scores.write_scores(made, path)
    scores.write_scores(made, path)
    scores.write_scores(made.union(made).union(_scores(spark, (3, 0.75, "a", "1"), (3, 0.5, "a", "1"))), path)
    store = scores.read_scores(spark, path)
    assert rows(store, "study_id", "score") == [(1, 0.5), (2, 0.25), (3, 0.75)] and rows(scores.find_duplicates(store)) == []


def test_a_half_written_append_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    scores.write_scores(_scores(spark, (1, 0.5, "a", "1")), path)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            scores.write_scores(_scores(spark, (2, 0.5, "a", "1")), path)
    assert len(os.listdir(f"{path}/data")) == 2
    assert rows(scores.read_scores(spark, path), "study_id") == [(1,)]
    scores.write_scores(_scores(spark, (2, 0.5, "a", "1")), path)
    assert rows(scores.read_scores(spark, path), "study_id") == [(1,), (2,)]


def test_of_two_writers_the_second_starts_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    scores.write_scores(_scores(spark, (1, 0.5, "a", "1")), path)
    commit, raced = manifest.commit, []

    def slower(*args):
        if not raced:
            # Another writer takes the number between the look and the commit.
            raced.append(1)
            scores.write_scores(_scores(spark, (2, 0.9, "a", "1"), (3, 0.9, "a", "1")), path)
        return commit(*args)

    monkeypatch.setattr(manifest, "commit", slower)
    scores.write_scores(_scores(spark, (2, 0.1, "a", "1"), (4, 0.1, "a", "1")), path)
    assert rows(scores.read_scores(spark, path), "study_id", "score") == [(1, 0.5), (2, 0.9), (3, 0.9), (4, 0.1)]
    assert manifest.latest(spark, path)[0] == 3 and not manifest.commit(spark, path, 3, manifest.EMPTY)


def test_a_store_without_rows(spark, tmp_path):
    assert scores.read_scores(spark, str(tmp_path / "none")).count() == 0
    scores.write_scores(_scores(spark, (1, 0.5, "a", "1")).limit(0), str(tmp_path / "none"))
    assert scores.read_scores(spark, str(tmp_path / "none")).count() == 0


def test_filter_keeps_every_key_and_few_others(spark):
    keys = spark.range(0, 60_000, 3).withColumnRenamed("id", "k")
    bitmaps, blocks = membership.key_filter(keys, "k")
    passed = {r.k for r in membership.maybe_in(spark.range(60_000).withColumnRenamed("id", "k"), "k", bitmaps, blocks).collect()}
    assert passed >= set(range(0, 60_000, 3)) and len(passed) - 20_000 < 1_000
    nobody = membership.key_filter(keys.limit(0), "k")
    assert membership.maybe_in(keys, "k", *nobody).count() == 0


def test_stored_signals_are_tested_where_they_are_read(spark, tmp_path):
    """No exchange below the scoring on the signals' side, and what no model wants stops at the scan."""
    models = {"a": _model(str(tmp_path), "a", 1.0, 3)}
    signals = spark.range(300).selectExpr("id as study_id", "array(array(1D, 2D), array(3D, double(id))) as signal")
    stored = shards.bucketed(signals, str(tmp_path / "signals"), "study_id", 4)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
    done = spark.range(290).selectExpr("id as study_id", "'a' as model", "'1' as version")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scoring.score_all(stored, models, done)
        plan = plan_of(out)
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.study_id, r.score) for r in got) == [(i, 6.0 + i) for i in range(290, 300)]
    scan = plan[: plan.index("Bucketed: true")]
    side = scan[scan.rindex("Join [study_id"):]
    assert "Exchange" not in side and side.count("BroadcastHashJoin") == 1

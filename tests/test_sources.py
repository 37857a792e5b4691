import glob
import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.columns import parse_model_name
from pulsegrid.plans.history import history_report
from pulsegrid.schemas import HISTORY, PATIENTS, RECORD_LIST, schema
from pulsegrid.sources import scores, scratch, shards, tables
from tests.helpers import at, plan_of, rows


def test_csv_round_trip_keeps_microseconds(spark, tmp_path):
    path = str(tmp_path / "records")
    df = spark.createDataFrame([(1, 2, 2, "p/2", at(microseconds=123456)), (3, 4, 4, None, None)], RECORD_LIST)
    tables.write_table(df, path, "csv")
    assert rows(tables.read_table(spark, path, RECORD_LIST)) == rows(df)
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_table(df, path, "csv")


def test_plain_times_are_read(spark, tmp_path):
    (tmp_path / "r.csv").write_text("subject_id,study_id,file_name,path,ecg_time\n1,2,2,p,2024-03-01 12:00:00\n")
    assert tables.read_table(spark, str(tmp_path / "r.csv"), RECORD_LIST).first().ecg_time == at()


def test_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("extra,subject_id,study_id,file_name,ecg_time,path\nx,1,2,3,2024-03-01 12:00:00,p\n")
    got = tables.read_table(spark, str(tmp_path / "r.csv"), RECORD_LIST).first()
    assert (got.subject_id, got.study_id, got.path, got.ecg_time) == (1, 2, "p", at())
    (tmp_path / "short.csv").write_text("subject_id,study_id\n1,2\n")
    with pytest.raises(ValueError, match="no columns"):
        tables.read_table(spark, str(tmp_path / "short.csv"), RECORD_LIST)


def test_strict_read_refuses_bad_values(spark, tmp_path):
    (tmp_path / "p.csv").write_text("subject_id,gender,anchor_age,anchor_year\n1,f,old,2020\n")
    path = str(tmp_path / "p.csv")
    assert tables.read_table(spark, path, PATIENTS).first().anchor_age is None
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_table(spark, path, PATIENTS, strict=True).collect()


def test_first_line_is_the_header(spark, tmp_path):
    (tmp_path / "a-x-history.csv").write_text("step,epoch,loss\n9,0,1.5\nloss,1,2.5\n")
    df = tables.read_many(spark, str(tmp_path / "*.csv"), HISTORY, "model", by_name=True)
    assert rows(df, "epoch", "loss") == [(0, 1.5), (1, 2.5)]


def test_typed_read_tidies_names_and_skips(spark, tmp_path):
    (tmp_path / "o.csv").write_text('X,Subject ID,stayId\n0,5,7\n')
    df = tables.read_typed(spark, str(tmp_path / "o.csv"), schema(**{"X": "long", "Subject ID": "long", "stayId": "long"}), ["x"])
    assert df.columns == ["subject_id", "stay_id"] and rows(df) == [(5, 7)]
    assert [tables.clean_name(n) for n in (" A-b (%) ", "1st", "", "ICU.intime")] == ["a_b", "x1st", "x", "icu_intime"]


def test_many_files_of_one_layout(spark, tmp_path):
    for name in ("train", "test"):
        (tmp_path / f"{name}.csv").write_text(f"subject_id,gender,anchor_age,anchor_year\n1,{name[0]},50,2020\n")
    df = tables.read_many(spark, str(tmp_path / "*.csv"), PATIENTS)
    assert sorted((r.gender, r.file.rsplit("/", 1)[1]) for r in df.collect()) == [("t", "test.csv"), ("t", "train.csv")]


def test_histories_with_differing_columns(spark, tmp_path):
    (tmp_path / "cnn-age-history.csv").write_text("epoch,loss,mse,val_loss\n0,1.5,2.5,\n1,1.25,2.0,3.5\n")
    (tmp_path / "resnet-gender-history.csv").write_text("epoch,auc,loss,val_loss\n0,0.75,0.5,0.25\n")
    glob_ = str(tmp_path / "*-history.csv")
    df = parse_model_name(tables.read_many(spark, glob_, HISTORY, "model", by_name=True))
    assert rows(df, "model", "epoch", "loss", "val_loss", "mse", "auc") == [
        ("cnn-age", 0, 1.5, None, 2.5, None),
        ("cnn-age", 1, 1.25, 3.5, 2.0, None),
        ("resnet-gender", 0, 0.5, 0.25, None, 0.75),
    ]
    report = history_report(spark, glob_)
    assert report.columns == ["model", "task", "epoch", "name", "value"] and report.count() == 6


def test_quoted_fields_hold_commas_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a-x-history.csv").write_text('"the, note",loss,epoch\n"a, ""b""\nc",1.5,0\nplain, 2.5 ,1\n"",,2\n')
    (tmp_path / "b-y-history.csv").write_text('epoch,"multi\nline",loss,loss\n3,"x, y",4.5,9\n4,"z"\n')
    (tmp_path / "c-z-history.csv").write_text("")
    (tmp_path / "d-z-history.csv").write_text("loss,epoch\n")
    read = schema(**{"epoch": "int", "loss": "double", "the, note": "string"})
    df = tables.read_many(spark, str(tmp_path / "*.csv"), read, "model", by_name=True)
    assert rows(df, "epoch", "loss", "the, note") == [(0, 1.5, 'a, "b"\nc'), (1, 2.5, "plain"), (2, None, None), (3, 4.5, None), (4, None, None)]
    assert {r.model.rsplit("/", 1)[1] for r in df.select("model").collect()} == {"a-x-history.csv", "b-y-history.csv"}


def test_headers_of_packed_and_split_files(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wt") as file:
        file.write("loss,epoch\n0.5,1\n")
    (tmp_path / "b.csv").write_text("\ufeffepoch,loss\n2,0.25\n")
    assert rows(tables.read_many(spark, str(tmp_path / "*"), HISTORY, by_name=True, line_breaks=False), "epoch", "loss") == [(1, 0.5), (2, 0.25)]
    nothing = tables.read_many(spark, [str(tmp_path / "e")], HISTORY, by_name=True) if (tmp_path / "e").write_text("") else None
    assert nothing is None


def test_score_map_in_one_object(spark, tmp_path):
    values = {str(i): i / 7 for i in range(5000)} | {"101": 63.5, "102": None, "103": float("nan"), "-4": -1e-07}
    (tmp_path / "m.json").write_text(json.dumps(values))
    df = scores.read_score_map(spark, str(tmp_path / "m.json"))
    got = {r.study_id: r.age_pred for r in df.collect()}
    want = {int(k): (None if v is None or v != v else v) for k, v in values.items()}
    assert got == want


def test_score_map_round_trip(spark, tmp_path):
    df = spark.range(-50, 2500).select(F.col("id").alias("study_id"), (F.col("id") / 3).alias("age_pred"))
    scores.write_score_map(df, str(tmp_path / "m"))
    for line in open(glob.glob(str(tmp_path / "m" / "*.txt"))[0]):
        json.loads(line)
    assert rows(scores.read_score_map(spark, str(tmp_path / "m"))) == rows(df)


def test_shards_are_bounded_and_pruned(spark, tmp_path):
    path = str(tmp_path / "shards")
    df = spark.range(3000).select(
        "id", F.when(F.col("id") < 2000, "train").otherwise("val").alias("split"), F.lit(1.0).alias("potassium mmol"), F.array(F.lit(1.0)).alias("signal")
    )
    shards.write_shards(df.coalesce(1), path)
    files = glob.glob(f"{path}/*/*.parquet")
    assert max(spark.read.parquet(f).count() for f in files) == 512
    assert len(files) == 4 + 2
    part = shards.read_split(spark, path, "val", ["id", "potassium mmol"])
    assert part.count() == 1000
    plan = plan_of(part)
    assert "PartitionFilters: [isnotnull(split" in plan and "signal" not in plan


def test_score_store(spark, tmp_path):
    path = str(tmp_path / "store")
    one = spark.createDataFrame([(1, "a", "1", 0.5)], "study_id long, model string, version string, score double")
    two = spark.createDataFrame([(2, "a", "1", 0.75), (1, "b", "1", 9.0)], one.schema)
    scores.write_scores(one, path)
    scores.write_scores(two, path)
    read = scores.read_scores(spark, path)
    assert rows(read, "study_id", "model", "score") == [(1, "a", 0.5), (1, "b", 9.0), (2, "a", 0.75)]
    assert scores.find_duplicates(read).count() == 0
    scores.write_scores(one.withColumn("score", F.lit(0.25)), path, mode="overwrite")
    spark.catalog.refreshByPath(path)
    assert rows(scores.read_scores(spark, path), "study_id", "model", "score") == [(1, "a", 0.25), (1, "b", 9.0)]
    assert rows(scores.find_duplicates(one.union(one)), "study_id") == [(1,)]


def test_cut_is_a_written_table_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    again = scratch.cut(spark.range(5))
    assert rows(again) == [(i,) for i in range(5)]
    assert "FileScan" in plan_of(again) and again.inputFiles()[0].removeprefix("file://").startswith(base)

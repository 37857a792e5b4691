from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import columns as C
from pulsegrid.functions.hashing import unit_hash
from pulsegrid.operators import reshape, sampling, splitting
from tests.helpers import at, plan_of, rows


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_offsets_are_wall_clock_and_keep_microseconds(spark, zone):
    """Neither a session zone nor its clock changes (10 March 2024) may shift an offset."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        start = datetime(2024, 3, 9, 12)
        gap = timedelta(hours=30, microseconds=1)
        df = spark.createDataFrame([(start + gap, start)], "a timestamp_ntz, b timestamp_ntz")
        seconds, minutes, hours = df.select(
            C.seconds_between("a", "b"), C.offset("a", "b"), C.offset("b", "a", "hour")
        ).first()
        assert str(seconds) == "108000.000001"
        assert minutes == pytest.approx(1800 + 1e-6 / 60, abs=1e-12) and hours == pytest.approx(-30, abs=1e-9)
        micros = df.select(C.epoch_micros("b")).first()[0]
        assert micros == (start - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_times_picks_columns_by_name(spark):
    df = spark.createDataFrame([("2024-03-01 12:00:00", "x", "2024-03-01 12:00:00")], "ecg_time string, a string, time string")
    parsed = C.parse_times(df)
    assert dict(parsed.dtypes) == {"ecg_time": "timestamp_ntz", "a": "string", "time": "string"}
    assert parsed.first().ecg_time == at()


def test_both_mortality_flags(spark):
    df = spark.createDataFrame(
        [(1, at(), at(), 1), (2, at(), at(), 0), (3, at(), at(hours=1), 1), (4, None, at(), 1), (5, at(), at(), None)],
        "i int, icu_outtime timestamp_ntz, dischtime timestamp_ntz, hospital_expire_flag int",
    )
    out = df.select("i", C.icu_expire_flag().alias("a"), C.icu_mort().alias("b"))
    assert rows(out) == [(1, 1, True), (2, 1, False), (3, 0, False), (4, 0, False), (5, 1, False)]


def test_age_and_gender(spark):
    df = spark.createDataFrame(
        [("M", at(), 50, 2020), ("F", at(), 50, 2024), (None, at(), None, None)],
        "g string, ecg_time timestamp_ntz, anchor_age int, anchor_year int",
    )
    assert rows(df, C.encode_binary("g"), C.anchored_age()) == [(0, 50), (0, None), (1, 54)]


def test_missing_values_and_bounds(spark):
    df = spark.createDataFrame([(1, 90.0), (2, 90.1), (3, None), (4, float("nan")), (5, 12.0)], "i int, x double")
    assert rows(C.drop_missing(df, ["x"]), "i") == [(1,), (2,), (5,)]
    assert rows(C.cap_filter(C.drop_missing(df, ["x"]), "x", 90.0), "i") == [(1,), (5,)]
    assert rows(C.cap_filter(df, "x", 90.0, inclusive=False), "i") == [(5,)]
    assert rows(C.nan_to_null(df, ["x"]).where("x is null"), "i") == [(3,), (4,)]
    assert C.fill_nan(df, ["x"]).where(F.isnan("x")).count() == 2


def test_bound_reaches_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "cast(id as double) x", "'w' as wide").write.parquet(path)
    plan = plan_of(C.cap_filter(spark.read.parquet(path), "x", 5.0).select("id"))
    assert "LessThanOrEqual(x,5.0)" in plan and "wide" not in plan


def test_model_names(spark):
    names = ["../data/resnet-age2-history.csv", "cnn-sodium", "/x/tl-age-mort-history.csv/part-0.csv"]
    df = spark.createDataFrame([(n,) for n in names], "model string")
    assert rows(C.parse_model_name(df)) == [
        ("cnn-sodium", "cnn", "sodium"), ("resnet-age2", "resnet", "age"), ("tl-age-mort", "tl", "age"),
    ]


def test_select_rename(spark):
    df = spark.createDataFrame([(1, 2)], "A int, B int")
    assert C.select_rename(df, {"B": "Potassium"}, lower=True).columns == ["potassium"]


@pytest.mark.parametrize("mode", ["xxhash64", "md5"])
def test_hash_is_uniform_and_repeatable(spark, mode):
    df = spark.range(20000).select(unit_hash(F.col("id"), mode=mode).alias("u"))
    lo, hi, mean, sd = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.stddev("u")).first()
    assert 0 <= lo and hi < 1 and abs(mean - 0.5) < 0.01 and abs(sd - 12**-0.5) < 0.01
    assert rows(df.limit(5)) == rows(spark.range(20000).select(unit_hash(F.col("id"), mode=mode)).limit(5))
    with pytest.raises(ValueError):
        unit_hash(F.col("id"), mode="other")


def test_split_keeps_subjects_together(spark):
    df = spark.range(6000).select((F.col("id") % 1500).alias("subject_id"), "id")
    split = splitting.group_split(df)
    assert splitting.split_leaks(split).count() == 0
    splitting.assert_disjoint(split)
    share = {r.split: r.n / 6000 for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert share["test"] == pytest.approx(0.2, abs=0.04) and share["val"] == pytest.approx(0.16, abs=0.04)
    assert rows(split) == rows(splitting.group_split(df.repartition(3)))
    assert "Exchange" not in plan_of(split)


@pytest.mark.parametrize("n, sizes", [(5, (3, 1, 1)), (11, (6, 2, 3)), (1, (0, 0, 1)), (1000, (640, 160, 200))])
def test_exact_split_sizes(spark, n, sizes):
    df = spark.range(2 * n).select((F.col("id") % n).alias("subject_id"), "id")
    split = splitting.group_split_exact(df)
    assert split.count() == 2 * n and splitting.split_leaks(split).count() == 0
    got = {r.split: r.n for r in split.groupBy("split").agg(F.count_distinct("subject_id").alias("n")).collect()}
    assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == sizes


def test_leaks_are_found(spark):
    df = spark.createDataFrame([(1, "train"), (1, "val"), (2, "test")], "subject_id long, split string")
    assert rows(splitting.split_leaks(df)) == [(1, 2)]
    with pytest.raises(ValueError, match="subject_id"):
        splitting.assert_disjoint(df)


def test_samples_and_shuffles(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("stay_id"), "id")
    some = sampling.sample_groups(df, "stay_id", 3)
    assert some.count() == 30 and some.select("stay_id").distinct().count() == 3
    assert rows(some) == rows(sampling.sample_groups(df.repartition(7), "stay_id", 3))
    assert sampling.sample_groups(df, "stay_id", 50).count() == 100
    orders = [[r.id for r in sampling.epoch_shuffle(df, "id", epoch=e).collect()] for e in (0, 0, 1)]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2]) == list(range(100))
    assert [r.id for r in sampling.first_n(df, ["id"], 2).collect()] == [0, 1]
    assert "TakeOrderedAndProject" in plan_of(sampling.first_n(df, ["id"], 2))


def test_epoch_order_without_a_sort(spark):
    df = spark.range(1000).selectExpr("id * 7 as id", "'x' as shards_of")
    sharded = sampling.number_shards(df, "id", rows_per_shard=30)
    orders = []
    for parts, epoch in ((1, 0), (9, 0), (4, 1)):
        out = sampling.epoch_order(sampling.number_shards(df.repartition(parts), "id", rows_per_shard=30), epoch=epoch)
        orders.append([r.id for r in out.orderBy("epoch_shard", "epoch_row").collect()])
        got = [(r.epoch_shard, r.epoch_row, r.shard) for r in out.collect()]
        turns = {shard: turn for turn, _, shard in got}
        assert len(set(got)) == 1000 and len(set(turns.values())) == len(turns) and all(0 <= t < 34 for t in turns.values())
        for shard, turn in turns.items():
            own = sorted(row for t, row, _ in got if t == turn)
            assert own == list(range(len(own)))
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2])
    placed = sampling.epoch_order(sharded)
    assert "rangepartitioning" not in plan_of(placed) and plan_of(placed).count("Exchange") == plan_of(sharded).count("Exchange")
    read = sampling.in_epoch_order(sampling.epoch_order(sharded), 4)
    assert "rangepartitioning" not in plan_of(read) and [r.id for r in read.collect()] == orders[0]
    assert sampling.epoch_order(sampling.number_shards(df.limit(0), "id")).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 100, 4097])
@pytest.mark.parametrize("mode", ["xxhash64", "md5"])
def test_permuted_is_a_permutation(spark, size, mode):
    from pyspark.sql import functions as F

    from pulsegrid.functions.hashing import permuted

    got = [r.p for r in spark.range(size).select(permuted(F.col("id"), F.lit(size), F.lit("a"), mode=mode).alias("p")).collect()]
    assert sorted(got) == list(range(size)) and (size < 100 or sum(p == i for i, p in enumerate(got)) < 10)


def test_reshapes(spark):
    a = spark.createDataFrame([(0, 1.0, 2.0)], "epoch int, loss double, val_loss double")
    b = spark.createDataFrame([(0, 3.0)], "epoch int, loss double")
    both = reshape.union_tagged({"cnn": a, "resnet": b}, "model")
    assert rows(both) == [(0, 1.0, 2.0, "cnn"), (0, 3.0, None, "resnet")]
    assert rows(reshape.pivot_metric(both, "epoch", "model", "loss", ["cnn", "resnet", "none"])) == [(0, 1.0, 3.0, None)]
    assert rows(reshape.unpivot_metrics(a, ["epoch"], ["loss", "val_loss"])) == [(0, "loss", 1.0), (0, "val_loss", 2.0)]
    pairs = spark.createDataFrame([(1, None)], "study_id long, label string")
    assert rows(reshape.count_unlabelled(pairs)) == [(1,)]

import random
from datetime import timedelta

import pytest

from pulsegrid.operators.joins import attach_labels, heavy_bins, interval_join, keep_keys, outer_join_all, pending
from tests.helpers import at, plan_of, rows

POINTS = "k long, p long, pt timestamp_ntz"
WINDOWS = "k long, w long, wt timestamp_ntz"


def brute(points, windows, before, after):
    return sorted(
        (p, w) for k, p, t in points for j, w, c in windows if k == j and c - before <= t <= c + after
    )


@pytest.mark.parametrize("width", [None, timedelta(minutes=13), timedelta(days=2)])
@pytest.mark.parametrize("n", [1, 17])
def test_interval_join_is_exact_at_any_bin_width(spark, width, n):
    rng = random.Random(1)
    points = [(rng.choice([1, 1, 1, 2, 3]), i, at(minutes=rng.randrange(2000))) for i in range(200)]
    windows = [(rng.choice([1, 1, 1, 2, 4]), i, at(minutes=rng.randrange(2000))) for i in range(60)]
    before, after = timedelta(hours=8), timedelta(hours=24)
    out = interval_join(
        spark.createDataFrame(points, POINTS).repartition(n),
        spark.createDataFrame(windows, WINDOWS).repartition(n),
        ["k"], "pt", "wt", before, after, bin_width=width,
    )
    assert out.columns == ["k", "p", "pt", "w", "wt"]
    assert rows(out, "p", "w") == sorted(brute(points, windows, before, after), key=lambda r: tuple(map(str, r)))


def test_interval_ends(spark):
    before, after, micro = timedelta(hours=8), timedelta(hours=24), timedelta(microseconds=1)
    points = [(1, 1, at() - before), (1, 2, at() - before - micro), (1, 3, at() + after), (1, 4, at() + after + micro), (1, 5, None)]
    out = interval_join(
        spark.createDataFrame(points, POINTS), spark.createDataFrame([(1, 9, at()), (1, 8, None)], WINDOWS),
        ["k"], "pt", "wt", before, after,
    )
    assert rows(out, "p", "w") == [(1, 9), (3, 9)]


def test_interval_join_spreads_a_hot_key(spark):
    """The join key has the time bin, and the range stays a condition of an equi-join."""
    p, w = spark.createDataFrame([(1, 1, at())], POINTS), spark.createDataFrame([(1, 1, at())], WINDOWS)
    plan = plan_of(interval_join(p, w, ["k"], "pt", "wt", timedelta(hours=1), timedelta(hours=1)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "hashpartitioning(k" in plan and "__bin" in plan.split("hashpartitioning(k")[1][:60]


@pytest.mark.parametrize("pairs", [1, 7, 50, 5000])
def test_heavy_bins_are_cut_into_tiles(spark, pairs):
    rng = random.Random(2)
    points = [(rng.choice([1, 1, 1, 1, 2, None]), i, rng.choice([at(), at(minutes=rng.randrange(3000))])) for i in range(150)]
    windows = [(rng.choice([1, 1, 1, 3, None]), i, rng.choice([at(), at(minutes=rng.randrange(3000))])) for i in range(70)]
    points += points[:5]
    hour = timedelta(hours=1)
    p, w = spark.createDataFrame(points, POINTS), spark.createDataFrame(windows, WINDOWS)
    out = interval_join(p, w, ["k"], "pt", "wt", hour, hour, tile_pairs=pairs)
    assert out.columns == ["k", "p", "pt", "w", "wt"]
    known = [[r for r in rows_ if r[0] is not None] for rows_ in (points, windows)]
    assert rows(out, "p", "w") == sorted(brute(*known, hour, hour), key=lambda r: tuple(map(str, r)))
    empty = interval_join(p.limit(0), w, ["k"], "pt", "wt", hour, hour, tile_pairs=pairs)
    assert empty.count() == 0


def test_tiles_hold_no_more_than_asked(spark):
    left = spark.range(3000).selectExpr("if(id < 2500, 1, id) as k")
    right = spark.range(900).selectExpr("if(id < 800, 1, id) as k")
    few = spark.range(2).selectExpr("1L as k")
    for a, b, n, m in ((left, right, 2500, 800), (left, few, 2500, 2), (few, left, 2, 2500)):
        (found,) = heavy_bins(a, b, ["k"], 1000).collect()
        assert found.k == 1 and -(-n // found.rows_in) * -(-m // found.columns_in) <= 1100
        assert (found.rows_in == 1) == (n == 2) and (found.columns_in == 1) == (m == 2)


def test_one_hot_instant_spreads_over_tasks(spark):
    """A third of both sides in one key and instant: its pairs come from many tasks, none with more than a few tiles."""
    from pyspark.sql import functions as F

    p = spark.range(6000).selectExpr("if(id < 2000, 0, id) as k", "id as p", "timestamp_ntz'2024-03-01 12:00:00' as pt")
    w = spark.range(1500).selectExpr("if(id < 500, 0, id + 100000) as k", "id as w", "timestamp_ntz'2024-03-01 12:00:00' as wt")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = interval_join(p, w, ["k"], "pt", "wt", timedelta(hours=1), timedelta(hours=1), tile_pairs=10_000)
        shares = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(shares) == 2000 * 500 and len(shares) >= 4 and max(shares) < 500_000


def test_shared_columns_are_refused(spark):
    p = spark.createDataFrame([(1, 1, at())], POINTS)
    with pytest.raises(ValueError, match="both sides"):
        interval_join(p, p, ["k"], "pt", "pt", timedelta(1), timedelta(1))


def test_full_outer_chain(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, a double")
    b = spark.createDataFrame([(2, 3.0), (3, 4.0)], "k long, b double")
    c = spark.createDataFrame([(4, 5.0)], "k long, c double")
    assert rows(outer_join_all([a, b, c], "k")) == [
        (1, 1.0, None, None), (2, 2.0, 3.0, None), (3, None, 4.0, None), (4, None, None, 5.0),
    ]


def test_full_outer_is_one_shuffle(spark):
    tables = [spark.range(50).selectExpr("id as k", f"if(id % {i + 2} = 0, id, null) as v{i}", f"'t' as s{i}").where(f"k % 5 <> {i}") for i in range(6)]
    out = outer_join_all(tables, "k")
    assert plan_of(out).count("Exchange") == 1
    want = [tuple([k] + [x for i in range(6) for x in ((k if k % (i + 2) == 0 else None, "t") if k % 5 != i else (None, None))]) for k in range(50)]
    assert rows(out) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_full_outer_nulls_and_repeated_keys(spark):
    a = spark.createDataFrame([(1, None), (None, 2.0)], "k long, a double")
    b = spark.createDataFrame([(None, 3.0), (1, 4.0)], "k long, b double")
    assert rows(outer_join_all([a, b], "k")) == [(1, None, 4.0), (None, 2.0, None), (None, None, 3.0)]
    with pytest.raises(Exception, match="twice"):
        outer_join_all([a, b.unionAll(b)], "k").collect()
    with pytest.raises(ValueError, match="several"):
        outer_join_all([a, a], "k")


def test_keep_keys_neither_repeats_nor_drops(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    keys = spark.createDataFrame([(1,), (1,), (9,)], "k long")
    assert rows(keep_keys(df, keys, "k")) == [(1, "a"), (1, "b")]


def test_pending_follows_versions(spark):
    records = spark.createDataFrame([(1,), (2,)], "study_id long")
    done = spark.createDataFrame([(1, "m", "1"), (2, "m", "0")], "study_id long, model string, version string")
    assert rows(pending(records, done, {"m": "1"})) == [(2, "m", "1")]
    assert rows(pending(records, done, {"m": "2"})) == [(1, "m", "2"), (2, "m", "2")]


def test_attach_labels_keeps_unlabelled_records(spark):
    records = spark.createDataFrame([(1,), (2,)], "study_id long")
    labs = spark.createDataFrame([(1, 4.0)], "study_id long, potassium double")
    stays = spark.createDataFrame([(2, 1)], "study_id long, icu_expire_flag int")
    assert rows(attach_labels(records, labs, stays)) == [(1, 4.0, None), (2, None, 1)]


def test_item_filter_reaches_the_scan(spark, tmp_path):
    from pulsegrid.plans.cohort import lab_pairs
    from pulsegrid.schemas import D_LABITEMS, LABEVENTS, RECORD_LIST

    for name, schema in (("labs", LABEVENTS), ("items", D_LABITEMS), ("records", RECORD_LIST)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    read = {n: spark.read.parquet(str(tmp_path / n)) for n in ("labs", "items", "records")}
    plan = plan_of(lab_pairs(read["records"], read["labs"], read["items"]))
    assert "In(itemid" in plan

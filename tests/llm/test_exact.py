import hashlib
import re
from collections import Counter, defaultdict

import pytest

from pulsegrid.llm import exact
from tests.helpers import plan_of


def brute(docs):
    """One result row per document: of equal texts the first by id stays, nulls last."""
    shas = [hashlib.sha256(re.sub("[ \t-\r]+", " ", t or "").encode()).hexdigest() for _, t in docs]
    least, sizes = {}, Counter(shas)
    for (i, _), sha in zip(docs, shas, strict=True):
        key = (i is None, i)
        if sha not in least or (key[0], key[1] or 0) < (least[sha][0], least[sha][1] or 0):
            least[sha] = key
    return sorted(((i, least[sha][1], sizes[sha], sha) for (i, _), sha in zip(docs, shas, strict=True)), key=str)


def check(df, docs):
    rows = exact.duplicates(df).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == brute(docs)
    stays = defaultdict(list)
    for r in rows:
        if r.kept:
            stays[r.text_sha256].append(r)
    # One row of each text stays, the one the others name.
    assert set(stays) == {r.text_sha256 for r in rows}
    assert all(len(own) == 1 and own[0].doc_id == own[0].keep_id for own in stays.values())


def test_edge_rows(edge):
    docs = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    check(edge, docs)
    assert len(exact.keep_first(edge).collect()) == len({s for *_, s in brute(docs)})


def test_keep_first_returns_rows_unchanged(edge):
    rows = exact.keep_first(edge).collect()
    whole = {tuple(r) for r in edge.collect()}
    assert all(tuple(r) in whole for r in rows)
    ids = {r.doc_id for r in rows}
    # 3 and 4 have one text, as have 1 and a null text; 7 stays before the null id.
    assert {1, 3, 7, 8}.issubset(ids) and not {2, 4} & ids


def test_columns_named_like_those_used_inside(spark):
    df = spark.createDataFrame([(1, "a", 5, 6), (2, "a", 7, 8)], "doc_id long, text string, __sha int, __block int").withColumnRenamed("__block", "block")
    assert [tuple(r) for r in exact.keep_first(df).collect()] == [(1, "a", 5, 6)]


def test_empty_table(nothing):
    assert exact.duplicates(nothing).count() == 0
    assert exact.keep_first(nothing).count() == 0


def test_long_table_of_equal_rows(spark):
    df = spark.range(20_000).selectExpr("cast(id % 2 as long) as doc_id", "'the  same' as text")
    rows = exact.duplicates(df)
    assert rows.where("kept").count() == 1
    assert rows.select("keep_id", "group_size").distinct().collect() == [(0, 20_000)]
    assert exact.keep_first(df).count() == 1


def test_hot_text_beside_many_others(spark):
    df = spark.range(30_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('text ', id div 2)) as text")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    check(df, docs)


def test_filter_loses_none_and_lets_few_pass(spark):
    n = 40_000
    df = spark.range(n).selectExpr("sha2(cast(if(id < 200, id div 2, id) as string), 256) as sha")
    bitmaps, blocks = exact.filter_of(df, "sha", n)
    tested = exact.maybe_repeated(df, "sha", bitmaps, blocks, "maybe")
    counts = df.groupBy("sha").count()
    seen = tested.join(counts, "sha").groupBy("maybe", (counts["count"] > 1).alias("repeated")).count().collect()
    by = {(r.maybe, r.repeated): r["count"] for r in seen}
    assert (False, True) not in by and by[(True, True)] == 200
    assert by[(True, False)] < n / 40


def test_a_full_filter_still_gives_exact_results(spark, monkeypatch):
    monkeypatch.setattr(exact, "MAX_BLOCKS", 1)
    df = spark.range(60_000).selectExpr("id as doc_id", "concat('t', id % 50000) as text")
    rows = exact.duplicates(df)
    assert rows.where("kept").count() == 50_000 and rows.where("group_size = 2").count() == 20_000


def test_only_rows_that_may_be_repeated_are_shuffled(edge):
    plan = plan_of(exact.keep_first(edge))
    alone = plan.split("Union")[1].split("Window")[0]
    assert "Exchange hashpartitioning" not in alone and "BatchEvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan


@pytest.mark.parametrize("text", ["a b", "a\t\r\n\x0b\x0c b", "a  b"])
def test_white_space_runs_are_one_space(spark, text):
    df = spark.createDataFrame([(2, text), (1, "a b"), (3, "a\xa0b"), (4, "a\x85b"), (5, " a b")], "doc_id long, text string")
    rows = {r.doc_id: r for r in exact.duplicates(df).collect()}
    assert rows[2].keep_id == 1 and rows[2].group_size == 2 and not rows[2].kept
    assert rows[3].group_size == rows[4].group_size == rows[5].group_size == 1

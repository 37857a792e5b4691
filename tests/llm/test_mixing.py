import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import mixing, queries
from tests.helpers import plan_of


def brute_targets(sizes, most=3.0):
    """Shares by weight, with the excess over the caps shared again until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if target[s] > most * sizes[s]]
        if not above:
            return {**target, **capped}
        capped |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, None: 5}, {"x": 0, "y": 7}, {"a": 5000, "b": 1, "c": 2, "d": 3, "e": 900, "f": 40, None: 77}, {"z": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


@pytest.mark.parametrize("size", [1, 2, 3, 64, 1000])
def test_permutation(spark, size):
    made = [r.p for r in spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), 1).alias("p")).collect()]
    assert sorted(made) == list(range(size)) and (size < 60 or made != sorted(made))


def check(rows, docs, block):
    by_source = defaultdict(list)
    for r, (_, text, source) in zip(rows, docs, strict=True):
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert 0 <= r.taken <= 3 * r["size"]
        by_source[source].append(r)
    targets = brute_targets({s: sum(r["size"] for r in own) for s, own in by_source.items()})
    for source, own in by_source.items():
        assert len({r.target for r in own}) == 1 and own[0].target == pytest.approx(targets[source])
        assert {r.source_size for r in own} == {sum(r["size"] for r in own)}
        # To the rounding of one block, and the last block, which may be short.
        assert abs(sum(r.taken for r in own) - targets[source]) <= 3 * block


def ordered(df, *cols):
    return sorted(df.collect(), key=lambda r: tuple(str(r[c]) for c in cols))


def test_edge_rows(edge):
    out = mixing.mixed_documents(edge)
    docs = edge.groupBy("doc_id", "text", "source").count()
    assert out.count() == edge.count() and docs.count() == edge.count() - 1
    totals = edge.join(mixing.mixed_documents(edge).groupBy("doc_id").agg(F.sum("taken").alias("all"), F.sum("size").alias("sizes")), "doc_id").select("all", "sizes").collect()
    assert all(r["all"] <= 3 * r["sizes"] for r in totals)


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source")
    out = queries.op5_mixing(spark, small)
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    rows = ordered(out, "doc_id")
    check(rows, [tuple(r) for r in ordered(docs, "doc_id")], 64)
    assert rows == ordered(queries.op5_mixing(spark, small), "doc_id")


def test_pieces_and_texts(spark):
    docs = [(i, " ".join(f"{i}.{k}" for k in range(50 * i)), "ab"[i % 2]) for i in range(1, 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    laid, pieces = mixing.mix(df, block=16, shard=8)
    made = pieces.collect()
    # Each slot of each shard holds one block, and the parts of a block follow one another.
    slots = defaultdict(int)
    for p in made:
        slots[p.shard, p.slot] += p.length
    assert max(slots.values()) <= 16 and {s for _, s in slots} <= set(range(8))
    taken = {r.doc_id: r.taken for r in mixing.mixed_documents(df, block=16).collect()}
    texts = {r.doc_id: r.text for r in mixing.mixed_texts(df, block=16).collect()}
    assert {i: len(t.split()) for i, t in texts.items()} == {i: n for i, n in taken.items() if n}
    whole = {i: f" {t} " for i, t, _ in docs}
    # Each line is a run of the document's words; a source with a target above its size gives whole documents first.
    assert all(f" {line} " in whole[i] for i, t in texts.items() for line in t.split("\n"))
    holes = {i: t.count("\n") for i, t in texts.items()}
    assert any(holes.values()) and all(n <= 3 * (len(whole[i]) // 16) for i, n in holes.items())


def test_empty_tables(spark, nothing):
    assert mixing.mixed_documents(nothing).count() == 0 and mixing.mixed_texts(nothing).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mixed_documents(blank).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import ann, queries, trees

SCHEMA = "vec_id long, embedding array<float>, label int, node string, key string, id string, query string, component string"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def odd(spark):
    """Nulls, zeros, non-finite components, another length, copies, repeated rows and ids."""
    return frame(
        spark,
        [
            (20, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.05, 0.0], 1), (4, [0.0, 1.0, 0.0], 1), (5, [1.0, 0.0, 0.0], 2), (6, [1.0, 0.0, 0.0], None),
            (7, None, 1), (8, [0.0, 0.0, 0.0], 1), (9, [NAN, 1.0, 0.0], 1), (10, [INF, 1.0, 0.0], 1), (11, [None, 1.0, 0.0], 1), (12, [], 1), (13, [1.0, 0.0], 1), (None, [1.0, 0.0, 0.0], 1),
            (14, [0.0, 1.0, 0.0], 1), (14, [0.0, 1.0, 0.0], 1), (40, [1e-30, 0.0, 0.0], 3), (41, [1e30, 0.0, 0.0], 3),
        ],
    )


def test_search_of_odd_rows(spark):
    out = ann.nearest(odd(spark), F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in out] == [(20, 1, 41), (20, 2, 2), (20, 3, 1), (40, 1, 41), (40, 2, 2), (40, 3, 1)]
    assert out[1].score == 2.0
    few = ann.nearest(odd(spark).where("vec_id IN (20, 1, 4)"), F.col("vec_id") % 20 == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(few, key=lambda r: r["rank"])] == [(1, 1.0), (4, 0.0)]
    assert ann.nearest(odd(spark).limit(0), F.col("vec_id") % 20 == 0).count() == 0


def vectors(path, spark):
    p = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    return p.vec_id.to_numpy(), np.stack(p.embedding).astype(float), p.label.to_numpy()


def test_recall(spark, small):
    ids, x, _ = vectors(small, spark)
    got = {}
    for r in queries.op8_neighbours(spark, small).collect():
        got.setdefault(r.query_id, []).append(r)
    found = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = (x * x[q]).sum(axis=1)
        rest = np.flatnonzero(ids != ids[q])
        best = rest[np.lexsort((ids[rest], -score[rest]))][:20]
        own = sorted(got[ids[q]], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21)) and [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        at = {i: k for k, i in enumerate(ids)}
        assert all(r.score == score[at[r.vec_id]] for r in own)
        found += len({r.vec_id for r in own} & set(ids[best].tolist()))
    assert found >= 0.9 * 20 * len(got)


def test_recall_on_a_larger_table(spark):
    path = "/root/testdata/sf0.1"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    ids, x, _ = vectors(path, spark)
    asked = np.flatnonzero(ids % 20 == 0)
    longest = float(np.sqrt((x**2).sum(axis=1).max()))
    found, least = 0, 20
    for q, own, _ in ann.search(x, ids, x[asked], ids[asked], longest, 20):
        exact = x @ x[asked[q]]
        exact[ids == ids[asked[q]]] = -np.inf
        hits = len(set(own.tolist()) & set(ids[np.lexsort((ids, -exact))[:20]].tolist()))
        found, least = found + hits, min(least, hits)
    assert found >= 0.93 * 20 * len(asked) and least >= 12


@pytest.mark.parametrize("dims", [32, 64])
def test_recall_beyond_one_block(dims):
    random = np.random.default_rng(2)
    base = random.standard_normal((4000, dims)) * random.uniform(0.5, 2, (4000, 1))
    ids, queries_ = np.arange(4000), base[:40]
    longest = float(np.sqrt((base**2).sum(axis=1).max()))
    found = 0
    for q, own, score in ann.search(base, ids, queries_, ids[:40], longest, 20):
        exact = base @ queries_[q]
        exact[q] = -np.inf
        found += len(set(own.tolist()) & set(np.argsort(-exact)[:20].tolist()))
        assert np.allclose(score, exact[own])
    assert found >= 0.9 * 20 * 40


def brute(ids, x, label, least=0.93):
    unit = x / np.sqrt((x**2).sum(axis=1))[:, None]
    near = (unit @ unit.T >= least) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    group = ids.copy()
    while True:
        new = np.array([min(group[near[i]].min(initial=group[i]), group[i]) for i in range(len(ids))])
        if (new == group).all():
            return near.sum(axis=1), group
        group = new


def test_dedup_of_odd_rows(spark):
    out = sorted(((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in trees.near_duplicates(odd(spark)).collect()))
    want = {20: (3, 1), 1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (2, 4), 14: (2, 4), 40: (1, 40), 41: (1, 40)}
    assert len(out) == 19
    for i, n, c, kept in out:
        expected = want.get(int(i), (0, int(i))) if i != "None" else (0, None)
        assert (n, c) == expected and kept == (i == "None" or c == int(i))
    assert trees.near_duplicates(odd(spark).limit(0)).count() == 0


def test_dedup_query(spark, small):
    ids, x, label = vectors(small, spark)
    links, group = brute(ids, x, label)
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op10_embedding_dedup(spark, small).collect()}
    assert got == {int(i): (int(n), int(g)) for i, n, g in zip(ids, links, group, strict=True)}


def test_forest_finds_links_across_leaves(spark, monkeypatch):
    random = np.random.default_rng(4)
    base = random.standard_normal((150, 16))
    x = np.concatenate([base + random.standard_normal(base.shape) * s for s in (0, 0.02, 0.1, 0.2, 0.3)])
    ids, label = np.arange(len(x)), np.tile(random.integers(0, 2, 150), 5)
    monkeypatch.setattr(trees, "LEAF", 64)
    df = spark.createDataFrame([(int(i), v.tolist(), int(y)) for i, v, y in zip(ids, x, label, strict=True)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in trees.near_duplicates(df).collect()}
    links, group = brute(ids, x, label)
    found = sum(n for n, _ in got.values()) / links.sum()
    assert found >= 0.98 and np.mean([got[i][1] == g for i, g in zip(ids, group, strict=True)]) >= 0.98


def test_large_leaves_are_split_on():
    random = np.random.default_rng(6)
    base = random.standard_normal((1500, 24))
    x = trees.unit(np.concatenate([base, base + random.standard_normal(base.shape) * 0.05]))
    pairs = {(min(a, b), max(a, b)) for i, j in trees.compare(x, 0.93, np.random.default_rng(1)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    exact = {(a, b) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.93, 1)))}
    assert pairs <= exact and len(pairs) >= 0.97 * len(exact)


def bundle(seed, n=3000, dims=64):
    """A third of the rows are near copies of one vector that are not equal."""
    random = np.random.default_rng(seed)
    x = random.standard_normal((n, dims))
    x[: n // 3] = x[0] + random.standard_normal((n // 3, dims)) * 0.12
    return x


def test_a_bundle_is_not_doubled_at_every_split():
    x = trees.unit(bundle(7, 12_000))
    for seed in range(trees.TREES):
        row, _ = trees.route(x, trees.plant(x, 12, seed, 40))
        count = np.bincount(row, minlength=len(x))
        assert count.min() >= 1 and count[:4000].mean() <= 6


def test_links_of_a_bundle_are_counted_in_blocks(spark, monkeypatch):
    x = bundle(8, 1500)
    ids, label = np.arange(len(x)), np.zeros(len(x), int)
    monkeypatch.setattr(trees, "LEAF", 128)
    monkeypatch.setattr(trees, "BLOCK", 64)
    made = {}
    cut = trees.cut
    monkeypatch.setattr(trees, "cut", lambda df, name: made.setdefault(name, cut(df, name)))
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in trees.near_duplicates(df).collect()}
    links, group = brute(ids, x, label)
    assert got == {int(i): (int(n), int(g)) for i, n, g in zip(ids, links, group, strict=True)}
    assert made["links"].count() < links.sum() / 4


def test_search_is_exact_with_copies():
    random = np.random.default_rng(4)
    base = random.standard_normal((3000, 64)) * random.uniform(0.5, 2, (3000, 1))
    base[100:130] = base[7]
    ids = np.arange(3000)
    longest = float(np.sqrt((base**2).sum(axis=1).max()))
    asked = np.arange(0, 3000, 20)
    for q, own, score in ann.search(base, ids, base[asked], ids[asked], longest, 20):
        exact = (base * base[asked[q]]).sum(axis=1)
        exact[asked[q]] = -np.inf
        best = np.lexsort((ids, -exact))[:20]
        assert own.tolist() == best.tolist() and score.tolist() == exact[best].tolist()

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import queries, spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs, least_length=6, least_count=5, ratio=5, modulus=199):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % modulus == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1 :]
            if len(low) >= least_length:
                n[low] += 1
    words = sorted(w for w, k in n.items() if k >= least_count)
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        top = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= ratio * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def check(df, **options):
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute(docs, **options)
    assert sorted(tuple(r) for r in spelling.variants(df, **options).collect()) == want
    return want


def test_edge_rows(edge):
    check(edge)
    check(edge, least_length=3, least_count=1, modulus=3)


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert sorted(tuple(r) for r in queries.op11_spelling(spark, small).collect()) == want and len(want) > 100


def test_empty_table(nothing):
    assert spelling.variants(nothing).count() == 0


def variants_table(spark, n=600, seed=3):
    """Words of many lengths and their misspellings, frequent and rare."""
    random = np.random.default_rng(seed)
    letters = list("aeiounrstléßÉ")
    rows = []
    for _ in range(n):
        word = "".join(random.choice(letters, random.integers(4, 9)))
        for _ in range(random.integers(0, 4)):
            k = random.integers(len(word) + 1)
            other = [word[:k] + word[k + 1 :], word[:k] + random.choice(letters) + word[k:], word[:k] + random.choice(letters) + word[k + 1 :]]
            rows.append(" ".join([other[random.integers(3)]] * int(random.integers(1, 4))))
        rows.append(" ".join([word] * int(random.integers(1, 30))))
    return spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "doc_id long, text string")


def test_small_blocks_lose_no_pair(spark, monkeypatch):
    df = variants_table(spark)
    want = check(df, least_length=3, least_count=1)
    assert sum(r[4] for r in want) > 500 and sum(r[1] is not None for r in want) > 100
    monkeypatch.setattr(spelling, "BLOCK", 16)
    monkeypatch.setattr(spelling, "INNER", 3)
    check(df, least_length=3, least_count=1)


def test_coarse_trees_deal_leaves_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 16)
    monkeypatch.setattr(spelling, "SAMPLE", 200)
    check(variants_table(spark, 300), least_length=3, least_count=1)


def test_anagrams_have_equal_vectors(spark, monkeypatch):
    from itertools import permutations

    monkeypatch.setattr(spelling, "BLOCK", 32)
    rows = ["".join(p) for p in permutations("abcdef")] + ["abcdeg", "abcde", "abcdeff"]
    check(spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "doc_id long, text string"), least_length=4, least_count=1)


def test_chains_lead_to_their_end(spark):
    words = [("stationary", 5), ("stationery", 30), ("stationerys", 170), ("stationeryss", 900)]
    df = spark.createDataFrame([(0, " ".join([w] * n)) for w, n in words], "doc_id long, text string")
    rows = {r.word: r for r in spelling.variants(df, modulus=10**12).collect()}
    assert rows["stationary"].form == "stationery" and {r.root for r in rows.values()} == {"stationeryss"}


def test_very_long_runs(spark):
    long = "ab" * 40_000
    df = spark.createDataFrame([(k, f"{long} {long}c word") for k in range(6)], "doc_id long, text string")
    rows = {len(r.word): r for r in spelling.variants(df, modulus=10**12).collect()}
    assert rows[80_000].n_near == rows[80_001].n_near == 1


def test_long_table_of_equal_rows(spark):
    df = spark.range(20_000).selectExpr("cast(id % 2 as long) as doc_id", "'Wonderful wonderfull' as text")
    rows = {r.word: (r.n, r.n_near) for r in spelling.variants(df, modulus=10**12).collect()}
    assert rows == {"wonderful": (20_000, 1), "wonderfull": (20_000, 1)}


@given(st.lists(st.text("abzéè", min_size=1, max_size=5), max_size=30, unique=True), st.lists(st.text("abzéè", min_size=1, max_size=5), max_size=30, unique=True))
@settings(max_examples=200, deadline=None)
def test_block_finds_each_pair_once(words, asked):
    for length in {len(w) for w in words}:
        own = [w for w in words if len(w) == length]
        block = spelling.Block(own, np.ones(len(own), np.int64))
        shorter = [w for w in asked if len(w) == length - 1]
        if shorter:
            i, j = block.near(shorter)
            assert sorted((shorter[a], own[b]) for a, b in zip(i, j, strict=True)) == sorted((a, b) for a in shorter for b in own if one_edit(a, b))
        i, j = block.near(own)
        got = sorted(tuple(sorted((own[a], own[b]))) for a, b in zip(i, j, strict=True))
        assert got == sorted({tuple(sorted((a, b))) for a in own for b in own if one_edit(a, b)})


@pytest.mark.parametrize("size", [2, 5])
def test_tree_reaches_all_near_vectors(size):
    random = np.random.default_rng(size)
    points = random.integers(0, 4, (400, spelling.DIMENSIONS)) * (random.random((400, spelling.DIMENSIONS)) < 0.2)
    asked = points.copy()
    asked[np.arange(400), random.integers(0, 32, 400)] += 1
    tree = spelling.Tree.over(asked.astype(np.int32), size)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(400))
    found = [set() for _ in range(400)]
    for leaf, rows in tree.search(points.astype(np.int32), up=True):
        for r in rows.tolist():
            found[r] |= set(tree.leaves[leaf].tolist())
    assert all(k in own for k, own in enumerate(found)) and np.mean([len(x) for x in found]) < 200

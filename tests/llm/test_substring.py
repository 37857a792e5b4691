import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import queries, sketch, substring, words


def brute(docs, width):
    """Rows (id, text) to (id, words, removed, digest), by the definition."""
    starts = defaultdict(set)
    order = lambda i: (i is None, i or 0)
    for i, t in docs:
        own = (t or "").encode().split()
        for k in range(len(own) - width + 1):
            starts[tuple(own[k : k + width])].add(order(i))
    out = []
    for i, t in docs:
        own = (t or "").encode().split()
        gone = set()
        for k in range(len(own) - width + 1):
            if min(starts[tuple(own[k : k + width])]) < order(i):
                gone.update(range(k, k + width))
        kept = b" ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, **args):
    return sorted((tuple(r) for r in substring.remove_repeated(df, texts=False, **args).collect()), key=str)


@pytest.mark.parametrize("width", [1, 3, 13])
def test_edge_rows(edge, width):
    assert run(edge, width=width) == brute([(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()], width)


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in queries.op3_substring_dedup(spark, small).collect()), key=str) == brute(docs, 13)


@pytest.mark.parametrize("tasks", [1, 5, 17])
def test_batches_settle_the_same(edge, tasks):
    assert run(edge.repartition(tasks)) == brute([(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()], 13)


def test_kept_text(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "x a  b\nc y")], "doc_id long, text string")
    assert [tuple(r) for r in substring.remove_repeated(df, width=3).orderBy("doc_id").collect()] == [(1, 4, 0, "a b c d"), (2, 5, 3, "x y")]


def test_empty_table(nothing):
    assert run(nothing) == []


def test_sketch_loses_nothing():
    random = np.random.default_rng(1)
    hashes = words.mix(random.integers(0, 50_000, 100_000).astype(np.uint64))
    batch = sketch._sketch_of(hashes, 20, 0)
    for blob in batch.column("gaps").to_pylist():
        cells = sketch.unpack_gaps(blob)
        assert (np.diff(cells) >= 0).all() and sketch.pack_gaps(cells) == blob
    far = np.array([0, 0, 254, 255, 256, 510, 511, 1 << 19])
    assert (sketch.unpack_gaps(sketch.pack_gaps(far)) == far).all()


def test_word_hashes_ignore_place():
    data = np.frombuffer(b"one two  one\ntwo", np.uint8)
    starts, ends, _ = words.split(data, np.array([0, len(data)]))
    h = words.range_hashes(data, starts, ends)
    assert len(h) == 4 and h[0] == h[2] and h[1] == h[3] and h[0] != h[1]


@pytest.mark.parametrize("size", [256, 1024, 2048])
def test_words_on_which_polynomial_hashes_agree(spark, size):
    """A Thue-Morse word and its complement: their difference has a factor of two for each doubling, at any base."""
    signs = [bin(k).count("1") % 2 for k in range(size)]
    one, other = ("".join("ab"[s ^ flip] for s in signs) for flip in (0, 1))
    start = " ".join(f"w{k}" for k in range(12))
    df = spark.createDataFrame([(1, f"{start} {one}"), (2, f"{start} {other}"), (3, f"{start} {one}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring.remove_repeated(df).collect()} == {1: 0, 2: 0, 3: 13}


@given(st.lists(st.binary(max_size=20), max_size=30))
@settings(max_examples=100, deadline=None)
def test_word_hashes_are_equal_for_equal_words_only(own):
    data = np.frombuffer(b"".join(own), np.uint8)
    ends = np.cumsum([len(w) for w in own]).astype(np.int64)
    starts = ends - np.array([len(w) for w in own], np.int64)
    for salt in (1, 2):
        h = words.word_hashes(data, starts, ends, salt).tolist()
        assert len({*zip(h, own, strict=True)}) == len(set(h)) == len(set(own))

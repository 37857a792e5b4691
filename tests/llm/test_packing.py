import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegrid.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


def check(rows, docs, length):
    """Pieces cover their documents, places are gapless, no sequence is too long."""
    tokenizer = reference()
    want = defaultdict(list)
    for i, text in docs:
        want[i].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4"))
    for i, texts in want.items():
        expected = []
        for ids in texts:
            first = len(ids) % length or length
            edges = [0, *range(first, len(ids) + 1, length)]
            expected += [(n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i) == sorted(expected)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= length
    return len(places)


def test_edge_rows(edge):
    docs = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    check(packing.pack_documents(edge, length=64).collect(), docs, 64)


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op1_packing(spark, small).collect()
    used = check(rows, docs, 1024)
    count = np.bincount([r.length for r in rows], minlength=1025)
    assert used <= packing.lower_bound(count, 1024) + 1


def test_ids_of_pieces(spark):
    df = spark.createDataFrame([(1, "a few words and more")], "doc_id long, text string")
    ids = [i for r in packing.pack_documents(df, length=3, with_ids=True).orderBy("piece").collect() for i in r.ids]
    assert ids == [*reference().encode("a few words and more", add_special_tokens=False).ids, 2]


def test_empty_table(nothing):
    assert packing.pack_documents(nothing).count() == 0


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_tokenizer(text):
    text = text.encode("utf-8", "ignore").decode()
    assert packing.token_ids(text, PATH).tolist() == [*reference_ids(text), 2]


_TOKENIZER = reference()


def reference_ids(text):
    return _TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["<|endoftext|> x", "a b   c\n\n d", "it's 12.5%!!  x\t\ty", "日本語テキスト", "a" * 3000])
def test_ids_of_odd_texts(text):
    assert packing.token_ids(text, PATH).tolist() == [*reference_ids(text), 2]


def least(lengths, capacity):
    """Fewest sequences, by trying all ways."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for n in range(len(rest) + 1):
        for pick in combinations(range(len(rest)), n):
            if first + sum(rest[k] for k in pick) <= capacity:
                best = min(best, 1 + least([x for k, x in enumerate(rest) if k not in pick], capacity))
    return best


@given(st.lists(st.integers(1, 20), max_size=7))
@settings(max_examples=60, deadline=None)
def test_few_pieces_are_packed_as_well_as_can_be(lengths):
    number, offset = packing.pack(np.array(lengths, np.int64), 20)
    want = least(sorted(lengths, reverse=True), 20)
    used = len(set(number.tolist()))
    assert packing.lower_bound(np.bincount(np.array(lengths, np.int64), minlength=21), 20) <= want <= used <= want + (len(lengths) > 5)
    for k in set(number.tolist()):
        assert sum(n for n, own in zip(lengths, number, strict=True) if own == k) <= 20


def test_search_beats_best_fit():
    # Best fit decreasing needs one more here.
    lengths = np.repeat([44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 120], 4)
    count = np.bincount(lengths, minlength=201)
    assert len(set(packing.pack(lengths, 200)[0].tolist())) <= len(packing.best_fit(count, 200))
    random = np.random.default_rng(1)
    lengths = random.integers(200, 700, 2000)
    count = np.bincount(lengths, minlength=1025)
    assert len(set(packing.pack(lengths, 1024)[0].tolist())) < len(packing.best_fit(count, 1024))


@pytest.mark.parametrize("text", ["<|endoftext|>", "a  <|endoftext|> x", "one<|endoftext|><|endoftext|>\n", "<|endoftext", "no token"])
def test_special_tokens_are_those_of_the_tokenizer_by_default(spark, text):
    want = [*Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, 2]
    assert packing.token_ids(text, PATH, special=True).tolist() == want
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = packing.pack_documents(df, length=64, with_ids=True).first()
    assert row.ids == want and row.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())

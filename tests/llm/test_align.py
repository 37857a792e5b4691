import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegrid.llm import align, queries

PATH_A, PATH_B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
A = Tokenizer.from_file(PATH_A)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
BYTES_A = align.byte_vocabulary(PATH_A)


def plain(text):
    """Groups of a text by the running lengths of its tokens' bytes alone, encoded as a whole."""
    if not text:
        return []
    ids_a, ids_b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    own_a, own_b = [BYTES_A[i] for i in ids_a], [align.piece_bytes(B.id_to_piece(i)) for i in ids_b]
    whole = (" " + text).encode()
    if b"".join(own_a) != whole or b"".join(own_b) != whole:
        return []
    ends = []
    for ids, own in ((ids_a, own_a), (ids_b, own_b)):
        at, found = 0, {}
        for k, (i, x) in enumerate(zip(ids, own, strict=True)):
            at += len(x)
            found[at] = k
        ends.append(found)
    out, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0][end] + 1, ends[1][end] + 1
        out.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    return out


def expected(docs):
    groups = [plain(t) for _, t in docs]
    count = Counter((a[-1], b[-1]) for own in groups for a, b in own)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (i, _), own in zip(docs, groups, strict=True):
        links = [(a[-1], b[-1]) for a, b in own]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
        sizes = sum(len(a) for a, _ in own), sum(len(b) for _, b in own)
        out.append((i, *sizes, len(own), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), sha))
    return sorted(out, key=str)


def texts_of(text):
    """As the operator gives it for one text."""
    own = align.Aligner(PATH_A, PATH_B) if not hasattr(texts_of, "own") else texts_of.own
    texts_of.own = own
    (groups,), sizes, links = own.texts([text])
    return (*sizes[0, :2].tolist(), groups, links)


def as_text(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


ODD = [
    "naïve café — 日本語テキスト \U0001f600\U0001f469‍\U0001f4bb x",
    "  two  spaces  and\ttabs\n\nlines \r\n end ",
    "it's 'quoted' they're !'s 12.5% a's",
    "<|endoftext|> <s> </s> <0x41> <unk>",
    "▁literal mark",
    "a ▁ b",
    "x\x00y \x85z \x1c w \x1f",
    " nbsp　wide  sep",
    "é combining ᾳ ﬁ Å Å ½ ２",
    "a" * 5000,
    "𝒳𝒴 ퟿ ￿",
    " ",
    "\n",
    "x",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    n_a, n_b, groups, links = texts_of(text)
    want = plain(text)
    assert groups == as_text(want)
    assert (n_a, n_b) == (sum(len(a) for a, _ in want), sum(len(b) for _, b in want))
    assert links.tolist() == [a[-1] << 32 | b[-1] for a, b in want]


@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n'.,s1éß日▁ \U0001f600<>x"), st.characters(exclude_categories=["Cs"])), max_size=40))
@settings(max_examples=400, deadline=None)
def test_any_text(text):
    assert texts_of(text)[2] == as_text(plain(text))


def test_bytes_that_differ_have_no_tokens():
    assert texts_of("a ▁ b")[:3] == (0, 0, "") and texts_of("")[:3] == (0, 0, "")


def test_ends_between_spans_follow_from_bytes():
    def ends(spans, sizes):
        lo, hi = np.array(spans).T
        return align.byte_ends(lo, hi, np.arange(len(lo)) == len(lo) - 1, np.array(sizes)).tolist()

    # A character of four bytes in three tokens, between a letter each.
    assert ends([(0, 1), (1, 5), (1, 5), (1, 5), (5, 6)], [1, 2, 1, 1, 1]) == [1, 3, 4, 5, 6]
    # Byte-fallback pieces have no span but the last one.
    assert ends([(0, 0), (0, 0), (0, 3)], [1, 1, 1]) == [1, 2, 3]


def test_texts_of_one_batch_are_aligned_alike():
    texts = ["", *ODD, "a ▁ b", "", "x ▁", "ab cd"]
    own = align.Aligner(PATH_A, PATH_B)
    for _ in range(2):
        groups, sizes, links = own.texts(texts)
        want = [plain(t) for t in texts]
        assert groups == [as_text(x) for x in want]
        assert sizes[:, 2].tolist() == [len(x) for x in want]
        assert links.tolist() == [a[-1] << 32 | b[-1] for x in want for a, b in x]


def test_edge_rows(edge):
    docs = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    rows = align.align(edge, digest=True).collect()
    assert sorted((tuple(r) for r in rows), key=str) == expected(docs)


def test_query(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op13_alignment(spark, small).collect()
    assert sorted((tuple(r) for r in rows), key=str) == expected(docs)


def test_rare_pairs_meet_their_documents_in_a_shuffle(spark, edge, monkeypatch):
    # With room for two pairs nearly all are looked up by a join.
    monkeypatch.setattr(align, "HEAVY", 2)
    docs = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in align.align(edge, digest=True).collect()), key=str) == expected(docs)


def test_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(align, "REMEMBERED", 10)
    own = align.Aligner(PATH_A, PATH_B)
    texts = ["some words here", "other words there", "some words again"]
    assert [own.texts([t])[0][0] for t in texts] == [as_text(plain(t)) for t in texts]


def test_groups_are_given_in_full(spark):
    df = spark.createDataFrame([(1, "a naïve café"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in align.align(df).collect()}
    assert rows[1].groups == as_text(plain("a naïve café")) and rows[2].groups == "" and rows[2].count_sum == 0


def test_empty_table(nothing):
    assert align.align(nothing).count() == 0


def test_long_table_of_equal_rows(spark):
    df = spark.range(5000).selectExpr("cast(id % 2 as long) as doc_id", "'the same words' as text")
    want = len(plain("the same words"))
    assert [tuple(r) for r in align.align(df).select("n_groups", "n_best", "count_sum").distinct().collect()] == [(want, want, want * 5000)]


def test_ends_follow_from_token_bytes_alone():
    """Only the ids of either tokenizer are read; character offsets and protos are not needed."""
    own = align.Aligner(PATH_A, PATH_B)
    a, b = own.a, own.b

    class Ids:
        def __init__(self, encoding):
            self.ids = encoding.ids

    class OnlyIdsA:
        def encode_batch(self, texts, **kw):
            return [Ids(x) for x in a.encode_batch(texts, **kw)]

    class OnlyIdsB:
        def encode(self, texts, **kw):
            assert kw.get("return_type") != "proto"
            return b.encode(texts, **kw)

    own.a, own.b = OnlyIdsA(), OnlyIdsB()
    texts = ["", *ODD, "a ▁ b", "", "x ▁", "ab cd"]
    groups, sizes, links = own.texts(texts)
    want = [plain(t) for t in texts]
    assert groups == [as_text(x) for x in want]
    assert links.tolist() == [a_[-1] << 32 | b_[-1] for x in want for a_, b_ in x]


def test_forgetting_keeps_the_pieces_met_again(monkeypatch):
    """Beyond the remembered characters, pieces asked for more than once stay; the others are forgotten; groups don't change."""
    monkeypatch.setattr(align, "REMEMBERED", 400)
    own = align.Aligner(PATH_A, PATH_B)
    common = "the common words of every text"
    texts = [f"{common} rare{k}word other{k}piece and{k}more" for k in range(40)] + ["", *ODD]
    for lo in range(0, len(texts), 5):
        part = texts[lo : lo + 5]
        groups, sizes, links = own.texts(part)
        want = [plain(t) for t in part]
        assert groups == [as_text(x) for x in want]
        assert links.tolist() == [a_[-1] << 32 | b_[-1] for x in want for a_, b_ in x]
        assert sizes.tolist() == [[sum(len(a_) for a_, _ in x), sum(len(b_) for _, b_ in x), len(x)] for x in want]
    assert own.known <= 400 + sum(map(len, texts[-5:])) + 5
    assert {"common", "words", "every"} <= set(own.number)
    assert not any(f"rare{k}word" in own.number for k in range(30))

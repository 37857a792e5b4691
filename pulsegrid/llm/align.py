"""Alignment of two tokenizers: where both have a token end, texts are cut into groups, and token pairs are counted.

The bytes of all tokens of a text must be those of a space and the text; texts of which they aren't have no tokens. So a
token ends where its bytes do, counted through the tokens of its text, whatever character offsets the tokenizers give.

Neither vocabulary has a token over a single space between two other characters, from which no token reaches
into the next word with its space. So texts are cut there, each distinct piece is encoded and aligned once as long as
a worker remembers it, and a text's groups are those of its pieces. A text with a piece whose bytes differ is encoded as a
whole, as are all texts if the piece vocabulary has a token with a space inside.

Spark counts the pairs of all texts (links, one per common end) by aggregation. Pairs with more than ``1 / HEAVY`` of all links
are ``HEAVY`` at most and are sent to every task; rarer ones meet their documents in a shuffle, where none is a hot key. The best count of a
piece id is a table no longer than the vocabulary.

Null and empty texts have no tokens: zeros and an empty string. A null id is kept. Repeated rows are rows of their
own, and each counts. Ties for the best count all count. Very long texts are cut at their spaces; one without any is a
single piece. An empty table gives an empty result. Other columns are not read, whatever their names. The links are
written below the shared folder when a plan is made, and pairs are counted then.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm import words
from pulsegrid.sources.scratch import cut

#: Pairs known to every task at most.
HEAVY = 1 << 20
#: A worker forgets its pieces beyond so many characters of them, all but those met again, up to a quarter of that.
REMEMBERED = 1_000_000
#: Characters of pieces encoded at once.
ENCODED = 200_000
#: Links looked up at once, or those of one longer text.
LOOKED_UP = 200_000
#: Bytes of texts aligned at once; a longer text is a group of its own.
GROUP = 1 << 20

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def byte_vocabulary(path: str) -> dict[int, bytes]:
    """Bytes of each id of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    # Printable bytes stand for themselves; the others are numbered from 256 on.
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return {i: bytes(letters[c] for c in token) for token, i in entries.items() if all(c in letters for c in token)}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: byte-fallback pieces are one byte, U+2581 is a space."""
    byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def byte_ends(lo: np.ndarray, hi: np.ndarray, last: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte after each token, from spans in bytes (``last`` marks a text's last token) and sizes of the decoded bytes.

    A span that ends where the next one starts, or the text does, is a cut; tokens since the last cut end their own bytes
    further on.
    """
    n = np.arange(len(lo))
    clean = (hi > lo) & (last | (np.r_[lo[1:], 0] >= hi))
    cuts = np.maximum.accumulate(np.where(clean | last, n, -1))
    before = np.r_[-1, cuts[:-1]] if len(cuts) else cuts
    done = np.cumsum(sizes)
    start = np.where(before >= 0, hi[before], 0)
    return np.where(clean, hi, start + done - np.where(before >= 0, done[before], 0))


def _open_ended(text: str) -> bool:
    return text[0].isspace() or text[-1].isspace()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start .. start + size - 1`` of all ranges, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given sizes."""
    sums, edges = np.r_[0, np.cumsum(values)], np.r_[0, np.cumsum(sizes)]
    return sums[edges[1:]] - sums[edges[:-1]]


class Aligner:
    """Both tokenizers of a worker and the pieces it has aligned, by number."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        known = byte_vocabulary(path_a)
        self.bytes_a = [known.get(i, b"") for i in range(max(known) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [piece_bytes(p) for p in pieces]
        self.size_a, self.size_b = (np.array([len(x) for x in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        #: A token's decimal id with what follows it: inside a group, at its end, at a text's end.
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.shown = [f"{i}{mark}" for mark in ",|;\n" for i in range(n)]
        self.divisible = not any(re.search(r"[^▁]▁", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.known = 0
        #: Groups of each piece; None if its bytes are not those of the piece.
        self.groups: list[str | None] = []
        self.sizes = np.zeros((0, 3), np.int64)
        self.links = np.zeros(0, np.int64)
        #: How often each piece was asked for.
        self.uses = np.zeros(0, np.int64)

    def keep_frequent(self) -> None:
        """Forgets the pieces, but keeps those asked for more than once, the most asked first, up to a quarter of ``REMEMBERED``."""
        pieces = list(self.number)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-self.uses, kind="stable")
        order = order[(self.uses[order] > 1) & (np.cumsum(length[order]) <= REMEMBERED // 4)]
        starts = np.r_[0, np.cumsum(self.sizes[:, 2])][order]
        groups, sizes, links = [self.groups[i] for i in order.tolist()], self.sizes[order], self.links[_ranges(starts, self.sizes[order, 2])]
        kept = [pieces[i] for i in order.tolist()]
        self.forget()
        self.number = dict(zip(kept, range(len(kept)), strict=True))
        self.known = int(length[order].sum())
        self.groups, self.sizes, self.links, self.uses = groups, sizes, links, np.ones(len(kept), np.int64)

    def aligned(self, texts: list[str], as_one: bool = False) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Groups, numbers of tokens and links (n x 3), and the links, of a space and each text (not empty).

        ``as_one`` is for texts that neither start nor end with white space: they are encoded with a space between them, where tokens
        end, and told apart by their bytes.
        """
        wholes = [b" " + t.encode() for t in texts]
        size = np.array([len(x) for x in wholes], np.int64)
        given = [" ".join(texts)] if as_one else texts
        ones = self.a.encode_batch([" " + t for t in given], add_special_tokens=False)
        others = self.b.encode(given, out_type=int, num_threads=1)
        n_a = np.array([len(x.ids) for x in ones], np.int64)
        ids_a = np.fromiter(chain.from_iterable(x.ids for x in ones), np.int64, n_a.sum())
        n_b = np.array([len(x) for x in others], np.int64)
        ids_b = np.fromiter(chain.from_iterable(others), np.int64, n_b.sum())
        sizes_a, sizes_b = self.size_a[ids_a], self.size_b[ids_b]
        joined = [b"".join(map(own.__getitem__, ids.tolist())) for own, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))]
        right = joined[0] == joined[1] == b"".join(wholes)
        if as_one and right:
            ends = np.cumsum(size)
            upto_a, upto_b = (np.searchsorted(np.cumsum(x), ends, "right") for x in (sizes_a, sizes_b))
            n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        right = right and len(n_a) == len(size) and (_sums(sizes_a, n_a) == size).all() and (_sums(sizes_b, n_b) == size).all()
        if not right:
            return self.aligned(texts) if as_one else self._some_aligned(texts, wholes, ids_a, n_a, ids_b, n_b)

        # The bytes of all tokens are those of the texts, one after the other: a token ends where its bytes do.
        end_a, end_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        has_a, has_b = np.zeros(size.sum() + 1, bool), np.zeros(size.sum() + 1, bool)
        has_a[end_a] = True
        has_b[end_b] = True
        cut_a, cut_b = has_b[end_a], has_a[end_b]
        links = ids_a[cut_a] << 32 | ids_b[cut_b]
        n_links = _sums(cut_a, n_a)

        # A group's first tokens stand before its second ones, whatever the numbers of either.
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        until_a, until_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        step = len(self.shown) // 4
        order[np.arange(len(ids_a)) + np.r_[0, until_b][group_a]] = ids_a + step * cut_a
        mark_b = 2 * cut_b
        mark_b[np.cumsum(n_b) - 1] = 3
        order[np.arange(len(ids_b)) + until_a[group_b]] = ids_b + step * mark_b
        shown = "".join(map(self.shown.__getitem__, order.tolist())).split("\n")[:-1]
        return shown, np.c_[n_a, n_b, n_links], links

    def _some_aligned(self, texts: list[str], wholes: list[bytes], ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray):
        """As ``aligned``, where the bytes of some texts differ: those have no tokens, the others are aligned without them."""
        a, b = iter(ids_a.tolist()), iter(ids_b.tolist())
        right = []
        for whole, k, m in zip(wholes, n_a.tolist(), n_b.tolist(), strict=True):
            own_a, own_b = (b"".join(own[i] for i in islice(ids, n)) for own, ids, n in ((self.bytes_a, a, k), (self.bytes_b, b, m)))
            right.append(own_a == own_b == whole)
        good = [t for t, ok in zip(texts, right, strict=True) if ok]
        shown, sizes, links = self.aligned(good) if good else ([], np.zeros((0, 3), np.int64), np.zeros(0, np.int64))
        out, all_sizes = iter(shown), np.zeros((len(texts), 3), np.int64)
        all_sizes[np.array(right)] = sizes
        return [next(out) if ok else None for ok in right], all_sizes, links

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """Numbers of the pieces in ``groups`` and ``sizes``; new ones are aligned."""
        # Pieces with white space at an end come last and are encoded one by one.
        new = sorted(set(pieces).difference(self.number), key=_open_ended)
        inner = len(new) - sum(map(_open_ended, new))
        sizes, links, lo = [self.sizes], [self.links], 0
        while lo < len(new):
            hi, size, stop = lo, 0, inner if lo < inner else len(new)
            while hi < stop and (hi == lo or size + len(new[hi]) <= ENCODED):
                size += len(new[hi]) + 8
                hi += 1
            shown, own_sizes, own_links = self.aligned(new[lo:hi], as_one=self.divisible and lo < inner)
            self.groups += shown
            sizes.append(own_sizes)
            links.append(own_links)
            lo = hi
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.known += sum(map(len, new))
        self.sizes, self.links = np.concatenate(sizes), np.concatenate(links)
        numbers = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        self.uses = np.r_[self.uses, np.zeros(len(self.number) - len(self.uses), np.int64)] + np.bincount(numbers, minlength=len(self.number))
        return numbers

    def texts(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """As ``aligned``, for texts that may be empty; a text whose bytes differ has no tokens."""
        if self.known > REMEMBERED:
            self.keep_frequent()
        cuts = [(_BETWEEN.split(t) if self.divisible else [t]) if t else [] for t in texts]
        n = np.array([len(own) for own in cuts], np.int64)
        numbers = self.numbers(list(chain.from_iterable(cuts)))
        own = self.sizes[numbers]
        sizes = np.c_[tuple(_sums(own[:, k], n) for k in range(3))]
        links = self.links[_ranges(np.r_[0, np.cumsum(self.sizes[:, 2])][numbers], own[:, 2])]
        shown, parts, wrong = [], map(self.groups.__getitem__, numbers.tolist()), []
        for k, m in enumerate(n.tolist()):
            groups = list(islice(parts, m))
            if None in groups:
                wrong.append(k)
                groups = []
            shown.append(";".join(groups))
        if not wrong:
            return shown, sizes, links
        # Encoded as a whole, where that is not what was tried.
        lists = np.split(links, np.cumsum(sizes[:, 2])[:-1])
        for k in wrong:
            (whole,), size, lists[k] = self.aligned([texts[k]]) if n[k] > 1 else ([None], np.zeros((1, 3), np.int64), links[:0])
            shown[k], sizes[k] = whole or "", size[0]
        return shown, sizes, np.concatenate(lists)


@lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _align(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, digest: bool) -> Iterator[pa.RecordBatch]:
    tools = aligner(path_a, path_b)
    for batch in batches:
        texts = words.texts_of(batch, "text")
        for lo, hi in words.groups(texts, GROUP):
            groups, sizes, links = tools.texts(texts[lo:hi].to_pylist())
            if digest:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes[:, 2])].astype(np.int32)), pa.array(links))
            numbers = [pa.array(np.ascontiguousarray(x)) for x in sizes.T]
            own = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [own.column("id"), own.column("row"), *numbers, pa.array(groups, pa.string()), lists], names=["id", "row", "n_a", "n_b", "n_links", "groups", "links"]
            )


def _known(batches: Iterator[pa.RecordBatch], heavy: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Sums over the links every task knows, and the list of the others."""
    # Pieces that a former task of this worker remembers are of no use here.
    aligner.cache_clear()
    pairs, counts, best = heavy

    def looked_up(rows: pa.Array, lists: pa.ListArray) -> pa.RecordBatch:
        sizes, links = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        place = np.minimum(np.searchsorted(pairs, links), max(len(pairs) - 1, 0))
        hit = pairs[place] == links if len(pairs) else np.zeros(len(links), bool)
        known = place[hit]
        weight, good = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
        weight[hit], good[hit] = counts[known], best[known]
        rest = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(_sums(~hit, sizes))].astype(np.int32)), pa.array(links[~hit]))
        return pa.RecordBatch.from_arrays([rows, pa.array(_sums(good, sizes)), pa.array(_sums(weight, sizes)), rest], names=["row", "n_best", "count_sum", "rest"])

    for batch in batches:
        edges = batch.column("links").offsets.to_numpy()
        lo = 0
        while lo < len(batch):
            hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + LOOKED_UP, "right")) - 1)
            part = batch.slice(lo, hi - lo)
            yield looked_up(part.column("row"), part.column("links"))
            lo = hi


def links_of(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``row``, numbers of tokens, groups, and ``links`` as ``a << 32 | b``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda b: _align(b, path_a, path_b, digest), f"id {id_type}, row long, n_a long, n_b long, n_links long, groups string, links array<long>")


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair``, ``n`` (links that hold it) and ``best`` (1 where ``n`` is the highest of its second id)."""
    counted = cut(links.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    # A row per id of the second vocabulary at most.
    highest = counted.groupBy(second.alias("second")).agg(F.max("n").alias("most"))
    return counted.join(F.broadcast(highest), second == F.col("second")).select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first: str | None = None,
    second: str | None = None,
    digest: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, and
    ``groups`` (``a1,a2|b1;a3|b2,b3``: ids of both in each group), or with ``digest`` its SHA-256 as ``groups_sha256``."""
    path_a = first or public_tokenizers.path("byte_bpe_50k.json")
    path_b = second or public_tokenizers.path("piece_bpe_32k.model")
    spark = docs.sparkSession
    links = cut(links_of(docs, id_col, text_col, path_a, path_b, digest), "links")
    pairs = cut(pair_counts(links), "best")
    total = links.agg(F.coalesce(F.sum("n_links"), F.lit(0))).first()[0]
    is_heavy = F.col("n") > total // HEAVY
    # Each is more than a HEAVY-th of all links, so there are fewer than HEAVY of them.
    table = pairs.where(is_heavy).toArrow().sort_by("pair")
    held = spark.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "n", "best")))
    known = cut(links.select("row", "links").mapInArrow(lambda b: _known(b, held.value), "row long, n_best long, count_sum long, rest array<long>"), "known")
    held.unpersist()
    rare = known.select("row", F.explode("rest").alias("pair")).join(pairs.where(~is_heavy), "pair")
    sums = known.select("row", "n_best", "count_sum").unionByName(rare.select("row", F.col("best").alias("n_best"), F.col("n").alias("count_sum")))
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return links.join(sums, "row").select(
        F.col("id").alias(id_col), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256" if digest else "groups")
    )

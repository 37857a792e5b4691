"""Spelling variants: words one edit apart, found by box-pruned range searches in k-d trees over letter counts.

Words are counted over all whole texts. A word's vector counts its letters in ``DIMENSIONS`` places: one edit puts
one letter in, takes one out, or both, so near words of one length are at most one up and one down apart (an L1 distance of two),
and near words whose lengths differ by one are one up apart. There is one tree for each length. Its splits come from a
bounded sample (``SAMPLE`` words of all lengths together); every word lies in the box of one leaf and is searched for in
the tree of its own length and that of the next one, in all leaves whose box is within reach. A leaf is a block of
words in one task, with a tree of its own below which vectors are compared, and letters in order for those that are near.
Of two words of one length only one searches for the other.

A leaf that holds more words than a block (words with equal vectors, or splits too coarse for a very large vocabulary) is
dealt into several blocks by a hash and searched in each, so a task holds one block whatever the vocabulary, and no
pair is lost. A word has fewer than ``200 * (length + 1)`` near words, so no word is a hot key of the links.

A word's form is its most frequent near word, if that is ``ratio`` times as frequent; roots follow by pointer doubling, in a
few rounds as counts grow by that ratio along a chain.

Null and empty texts have no words. A null id is an empty string where runs are hashed. Repeated rows count as often as
they stand there. Ties between near words go to the smaller one in code-point order. A very long run is a word like any
other, in smaller blocks. An empty table gives an empty result. Other columns are not read, whatever their names. Words
are counted, and their links written below the shared folder, when a plan is made.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm import words as texts_of_batches
from pulsegrid.sources.scratch import cut

#: Words a tree's splits are made from, of all lengths together.
SAMPLE = 65_536
#: Words of a block, and bytes of their letters.
BLOCK, BLOCK_BYTES = 2048, 1 << 22
#: Sample words a leaf of a tree has at least.
LEAST_SAMPLE = 8
#: Words of a leaf of the tree inside a block.
INNER = 24
#: Searches made at once in a block.
SEARCHED = 2048
#: Distinct words a task counts before it passes them on.
COUNTED = 300_000

#: a to z have a place each; the other letters share six.
DIMENSIONS = 32
_PLACE = np.array([c - 97 if 97 <= c < 123 else 26 + c % 6 for c in range(256)])


def vectors(letters: np.ndarray) -> np.ndarray:
    """Letter counts of words of one length, given as rows of bytes."""
    n = len(letters)
    cells = _PLACE[letters] + DIMENSIONS * np.arange(n)[:, None]
    return np.bincount(cells.ravel(), minlength=n * DIMENSIONS).reshape(n, DIMENSIONS).astype(np.int32)


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as rows of bytes; all letters are below U+0100."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


@dataclass
class Tree:
    """Splits ``vector[place] <= bound``; children at or above 0 are splits, below 0 leaves ``-1 - number``."""

    place: list[int] = field(default_factory=list)
    bound: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    root: int = -1

    @classmethod
    def over(cls, points: np.ndarray, size: int) -> Tree:
        """Splits until a leaf has ``size`` points or fewer, or all its points are equal."""
        tree = cls()
        tree.root = -1
        todo = [(np.arange(len(points)), -1, False)]
        while todo:
            rows, parent, is_high = todo.pop()
            split = tree._split(points[rows]) if len(rows) > size else None
            if split is None:
                number = -1 - len(tree.leaves)
                tree.leaves.append(rows)
            else:
                number = len(tree.place)
                tree.place.append(split[0])
                tree.bound.append(split[1])
                tree.low.append(0)
                tree.high.append(0)
                below = points[rows, split[0]] <= split[1]
                todo += [(rows[below], number, False), (rows[~below], number, True)]
            if parent < 0:
                tree.root = number
            else:
                (tree.high if is_high else tree.low)[parent] = number
        return tree

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int] | None:
        """The place and bound that part the points most evenly."""
        best, least, most = None, points.min(0), points.max(0)
        middle = np.median(points, axis=0).astype(np.int32)
        for shift in (-1, 0):
            bound = np.clip(middle + shift, least, most - 1)
            share = np.abs((points <= bound).mean(0) - 0.5)
            share[least == most] = 1
            k = int(share.argmin())
            if share[k] < 0.5 and (best is None or share[k] < best[0]):
                best = (share[k], k, int(bound[k]))
        return best and best[1:]

    def search(self, points: np.ndarray, up: bool = False, down: bool = False) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the rows of ``points`` that may have near vectors there: one count higher by one (``up``), one lower
        by one (``down``). With both, only those whose higher place comes after the lower one: the other word finds those
        where it is before."""
        none = np.full(len(points), -1, np.int8)
        todo = [(self.root, np.arange(len(points)), none, none)]
        while todo:
            node, rows, more, less = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -1 - node, rows
                continue
            place, bound = self.place[node], self.bound[node]
            x = points[rows, place] + (more == place) - (less == place)
            below, free = x <= bound, (more != place) & (less != place)
            low, high = [(below, None, None)], [(~below, None, None)]
            if up:
                high.append((below & free & (x == bound) & (more < 0) & (less < place), place, None))
            if down:
                low.append((~below & free & (x == bound + 1) & (less < 0) & ((more < 0) | (more > place)), None, place))
            for child, ways in ((self.low[node], low), (self.high[node], high)):
                own_rows = np.concatenate([rows[w] for w, _, _ in ways])
                own_more = np.concatenate([more[w] if m is None else np.full(w.sum(), m, np.int8) for w, m, _ in ways])
                own_less = np.concatenate([less[w] if m is None else np.full(w.sum(), m, np.int8) for w, _, m in ways])
                todo.append((child, own_rows, own_more, own_less))


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def _inserted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Where the longer word without one letter is the shorter one: equal letters from both ends meet."""
    front = np.logical_and.accumulate(longer[:, :-1] == shorter, axis=1).sum(1)
    back = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(1)
    return front + back >= shorter.shape[1]


class Block:
    """Words of one leaf, searched by others."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.words, self.counts = words, counts
        self.letters = letters_of(words)
        self.vectors = vectors(self.letters)
        self.tree = Tree.over(self.vectors, INNER)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of searching words and of words here that are one edit apart; for words of one length each pair in one of
        its two directions."""
        letters = letters_of(words)
        asked, same = vectors(letters), letters.shape[1] == self.letters.shape[1]
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for leaf, rows in self.tree.search(asked, up=True, down=same):
            own = self.tree.leaves[leaf]
            apart = self.vectors[own][None] - asked[rows][:, None]
            ups, downs = np.maximum(apart, 0).sum(2), np.maximum(-apart, 0).sum(2)
            close = (ups <= 1) & (downs <= int(same))
            if same:
                # Without a change of counts (letters that share a place), the first word searches.
                order = np.where(ups > 0, apart.argmax(2) > apart.argmin(2), True)
                close &= order
            i, j = np.nonzero(close)
            left.append(rows[i])
            right.append(own[j])
        i, j = np.concatenate(left), np.concatenate(right)
        found, step = [np.zeros(0, bool)], max(1, (1 << 24) // letters.shape[1])
        for lo in range(0, len(i), step):
            a, b = self.letters[j[lo : lo + step]], letters[i[lo : lo + step]]
            found.append(_replaced(a, b) if same else _inserted(a, b))
        good = np.concatenate(found)
        i, j = i[good], j[good]
        if same:
            equal = (asked[i] == self.vectors[j]).all(1)
            first = np.array([words[p] < self.words[q] for p, q in zip(i.tolist(), j.tolist(), strict=True)], bool)
            i, j = i[~equal | first], j[~equal | first]
        return i, j


def _run_counts(batches: Iterator[pa.RecordBatch], least: int, modulus: int) -> Iterator[pa.RecordBatch]:
    runs = re.compile(f"[a-zA-ZÀ-ÿ]{{{least},}}")
    totals: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        texts = texts_of_batches.texts_of(batch, "text")
        for k, text in zip(batch.column("id").to_pylist(), texts, strict=True):
            start = zlib.crc32(f"{'' if k is None else k}:".encode())
            # Bytes are lowered in ASCII only.
            for word, n in Counter(runs.findall(text.as_buffer().to_pybytes().lower().decode())).items():
                h = zlib.crc32(word.encode(), start)
                if h % modulus == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < least:
                        continue
                totals[word] += n
            if len(totals) > COUNTED:
                yield out()
                totals.clear()
    if totals:
        yield out()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, modulus: int = 199) -> DataFrame:
    """``word``, ``n``: lower-cased runs of letters, some with one letter left out by their hash, over all texts."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    counts = rows.mapInArrow(lambda b: _run_counts(b, least_length, modulus), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def fit_trees(words: DataFrame) -> dict[int, Tree]:
    """A tree for each length that has more words than a block, from ``SAMPLE`` words in all by a hash."""
    sizes = words.groupBy(F.length("word").alias("length")).count().where(F.col("count") > BLOCK)
    total = words.count()
    sampled = words.join(F.broadcast(sizes), F.length("word") == F.col("length"))
    # An order by hash; the limit bounds what reaches the driver.
    sampled = sampled.orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word", "count").toArrow().to_pydict() if total > BLOCK else {"word": [], "count": []}
    by_length: dict[int, list[str]] = {}
    count = {}
    for word, n in zip(sampled["word"], sampled["count"], strict=True):
        by_length.setdefault(len(word), []).append(word)
        count[len(word)] = n
    return {k: Tree.over(vectors(letters_of(own)), max(LEAST_SAMPLE, BLOCK * len(own) // count[k])) for k, own in by_length.items()}


_ROUTED = "length int, leaf int, part int, kind int, word string, n long"
_ROUTED_ARROW = pa.schema([("length", pa.int32()), ("leaf", pa.int32()), ("part", pa.int32()), ("kind", pa.int32()), ("word", pa.string()), ("n", pa.int64())])


def _limit(length: int) -> int:
    return max(1, min(BLOCK, BLOCK_BYTES // length))


def _routed(batches: Iterator[pa.RecordBatch], trees: dict[int, Tree], parts: dict[tuple[int, int], int], searching: bool) -> Iterator[pa.RecordBatch]:
    """Words at their leaves (kind 0) and, with ``searching``, at those to be searched: for words of their own length
    (kind 1) and of the next (kind 2)."""
    one = Tree.over(np.zeros((0, DIMENSIONS), np.int32), 1)

    def rows(batch: pa.RecordBatch, places: np.ndarray, length: int, kind: int, found: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for leaf, own in found:
            at = batch.take(pa.array(places[own]))
            n = parts.get((length, leaf), 1)
            for part in range(n if kind else 1):
                if kind:
                    part = np.full(len(own), part)
                else:
                    part = np.array([zlib.crc32(w.encode()) % n for w in at.column("word").to_pylist()]) if n > 1 else np.zeros(len(own))
                same = [pa.array(np.full(len(own), x), pa.int32()) for x in (length, leaf)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(part.astype(np.int32)), pa.array(np.full(len(own), kind), pa.int32()), at.column("word"), at.column("n")], schema=_ROUTED_ARROW)

    for batch in batches:
        words = batch.column("word").to_pylist()
        lengths = np.array([len(w) for w in words])
        for length in np.unique(lengths).tolist():
            every = np.flatnonzero(lengths == length)
            for lo in range(0, len(every), _limit(length)):
                places = every[lo : lo + _limit(length)]
                points = vectors(letters_of([words[k] for k in places.tolist()]))
                own, longer = trees.get(length, one), trees.get(length + 1, one)
                out = list(rows(batch, places, length, 0, own.search(points)))
                if searching:
                    out += rows(batch, places, length, 1, own.search(points, up=True, down=True))
                    out += rows(batch, places, length + 1, 2, longer.search(points, up=True))
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of the pairs found in each block; its own words come first."""
    key, held, counts, block = None, [], [], None
    for batch in batches:
        codes = np.c_[tuple(batch.column(k).to_numpy() for k in ("length", "leaf", "part", "kind"))]
        edges = np.r_[np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]).any(1)]), len(codes)] if len(codes) else np.zeros(1, np.int64)
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            *own, kind = codes[lo].tolist()
            words, n = batch.column("word").slice(lo, hi - lo).to_pylist(), batch.column("n").slice(lo, hi - lo).to_numpy()
            if own != key:
                key, held, counts, block = own, [], [], None
            if kind == 0:
                held += words
                counts.append(n)
                continue
            if not held:
                continue
            block = block or Block(held, np.concatenate(counts))
            step = min(SEARCHED, _limit(own[0]))
            for at in range(0, len(words), step):
                asked = words[at : at + step]
                i, j = block.near(asked)
                if len(i):
                    here, there = pa.array(block.words).take(pa.array(j)), pa.array(asked).take(pa.array(i))
                    n_here, n_there = block.counts[j], n[at : at + step][i]
                    columns = [pa.concat_arrays([here, there]), pa.concat_arrays([there, here]), pa.array(np.r_[n_there, n_here])]
                    yield pa.RecordBatch.from_arrays(columns, names=["word", "near", "n"])


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``near``, ``n`` (of ``near``): all ordered pairs of ``words`` that are one edit apart."""
    sc = words.sparkSession.sparkContext
    trees = sc.broadcast(fit_trees(words))
    # Leaves with more words than a block: fewer than all words by that number.
    leaves = words.mapInArrow(lambda b: _routed(b, trees.value, {}, False), _ROUTED).groupBy("length", "leaf").count()
    limit = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES) / F.col("length"))))
    large = leaves.where(F.col("count") > 2 * limit).select("length", "leaf", F.ceil(F.col("count") / limit).cast("int").alias("parts")).toArrow().to_pydict()
    parts = dict(zip(zip(large["length"], large["leaf"], strict=True), large["parts"], strict=True))
    held = sc.broadcast(parts)
    routed = words.mapInArrow(lambda b: _routed(b, trees.value, held.value, True), _ROUTED)
    dealt = routed.repartition("length", "leaf", "part").sortWithinPartitions("length", "leaf", "part", "kind")
    return dealt.mapInArrow(_links, "word string, near string, n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the end of the chain of ``forms`` (``word``, ``form``) that starts at each word."""
    out = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = out.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        out = cut(out.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("at").isNotNull().alias("moved")), "roots")
        if out.where("moved").isEmpty():
            return out.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, ratio: int = 5, modulus: int = 199) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = cut(word_counts(docs, id_col, text_col, least_length, least_count, modulus), "words")
    # The most frequent near word; of equal ones the least, in the order of UTF-8 bytes, which is that of code points.
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    far_more = -F.col("best.minus_n") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        F.when(far_more, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(far_more, -F.col("best.minus_n")).alias("form_n"),
    )
    found = cut(found, "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Substring dedup: repeated word windows found behind a count-min prefilter, exactly grouped, and cut out.

A window is ``width`` consecutive words of one document. Words covered by a window that also starts in a document
with a smaller id are removed; windows are judged on the input. First pass: partition sketches of all windows are
merged into one bitmap of the cells counting two or more. Second pass: windows the bitmap can't rule out are grouped
by 95 bits of two hashes, one row for each window and batch of documents, so a window of a third of all rows sends a row per
batch. The two are made from two independent hashes of each word. The texts meet the found ranges once, by document.

Null text: no words. Null id: such documents count as coming after all others and remove nothing from each other.
Rows with the same id and text are treated alike; rows with the same id and another text are documents of their own
that don't remove words from each other. An empty table gives an empty result. A very long text is a group
of its own. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm import sketch, words

#: Windows are compared inside a batch of about this many words before any leaves it.
BATCH_WORDS = 2_000_000
_LAST = (1 << 63) - 1
#: Second round's salt; see sketch.py.
SALT = 0x5851F42D4C957F2D
#: Rows of one document stand together and differ in two numbers only, which keeps the shuffle small: ``h`` and
#: ``place``, the second hash and the first word's number in one. ``hi`` is given for settled ranges alone.
_FOUND = "doc long, key long, h long, place long, hi int"
_FOUND_ARROW = pa.schema([("doc", pa.int64()), ("key", pa.int64()), ("h", pa.int64()), ("place", pa.int64()), ("hi", pa.int32())])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id with nulls last, a key of id and text, and the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    return docs.select(doc.alias("doc"), F.xxhash64(F.col(id_col), text).alias("key"), F.col(id_col).alias("id"), text.alias("text"))


def _windows(texts: pa.Array, width: int, tagged: bool = True) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
    """Hash, second hash (if ``tagged``), text number and first word's number in its text of every window."""
    data, bounds = words.raw(texts)
    starts, ends, text = words.split(data, bounds)
    h = words.rolling(words.word_hashes(data, starts, ends, 0x2545F4914F6CDD1D), width, 0xD6E8FEB86659FD93)
    n = len(h)
    inside = text[:n] == text[width - 1 :] if n else np.zeros(0, bool)
    tag = None
    if tagged:
        tag = words.rolling(words.word_hashes(data, starts, ends, 0x9E6C63D0876A9A47), width, 0xA0761D6478BD642F)
        tag = (tag[inside] >> np.uint64(33)).astype(np.int32)
    before = np.searchsorted(text, np.arange(len(texts)), "left")
    text, place = text[:n][inside], np.arange(n)[inside]
    return h[inside], tag, text, place - before[text]


def _maybe(h: np.ndarray, rounds: list[list[np.ndarray]]) -> np.ndarray:
    out = np.ones(len(h), bool)
    for salt, bitmaps in zip((0, SALT), rounds, strict=False):
        out[out] = sketch.maybe_repeated(h[out], bitmaps, salt)
    return out


def _found(batches: Iterator[pa.RecordBatch], width: int, rounds: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    n = 0

    def out() -> pa.RecordBatch:
        h, tag, doc, key, place = map(np.concatenate, zip(*held, strict=True))
        order = np.lexsort((doc, tag, h))
        h, tag, doc, key, place = h[order], tag[order], doc[order], key[order], place[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (tag[1:] != tag[:-1])][: len(h)]
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else doc
        known = doc > least
        # What this batch settles leaves it as ranges of starts of each document.
        k_key, k_doc, k_place = key[known], doc[known], place[known]
        order = np.lexsort((k_place, k_key))
        k_key, k_doc, k_place = k_key[order], k_doc[order], k_place[order]
        first = np.r_[True, (k_key[1:] != k_key[:-1]) | (k_place[1:] > k_place[:-1] + 1)][: len(k_key)]
        last = np.r_[first[1:], True][: len(k_key)]
        m = int(first.sum())
        rest = np.flatnonzero(~known)
        rest = rest[np.lexsort((place[rest], key[rest]))]
        both = tag[rest].astype(np.int64) << 32 | place[rest]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[doc[rest], k_doc[first]]),
                pa.array(np.r_[key[rest], k_key[first]]),
                pa.array(np.r_[h[rest].view(np.int64), k_key[first]]),
                pa.array(np.r_[both, k_place[first]]),
                pa.array(np.r_[np.zeros(len(rest)), k_place[last]].astype(np.int32), mask=np.arange(len(rest) + m) < len(rest)),
            ],
            schema=_FOUND_ARROW,
        )

    for batch in batches:
        texts = words.texts_of(batch, "text")
        docs, keys = batch.column("doc").to_numpy(), batch.column("key").to_numpy()
        for lo, hi in words.groups(texts):
            h, tag, text, place = _windows(texts[lo:hi], width)
            n += len(h)
            maybe = _maybe(h, rounds)
            text = text[maybe] + lo
            held.append((h[maybe], tag[maybe], docs[text], keys[text], place[maybe]))
            if n >= BATCH_WORDS:
                yield out()
                held, n = [], 0
    if held:
        yield out()


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """Rows ``key``, ``lo``, ``hi``: windows starting at words lo to hi (lo alone, if hi is null) of the document of
    that key are to be removed."""
    rows = _keyed(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sc = docs.sparkSession.sparkContext
    # Words are about six bytes long; the bitmaps' size is bounded by sketch.MAX_BITS.
    bits, rounds = sketch.bits_for(size // 6), []
    for salt in (0, SALT):
        held = sc.broadcast(rounds)

        def hashes(batch: pa.RecordBatch, held=held) -> Iterator[np.ndarray]:
            texts = words.texts_of(batch, "text")
            for lo, hi in words.groups(texts):
                h = _windows(texts[lo:hi], width, tagged=False)[0]
                yield h[_maybe(h, held.value)]

        rounds = [*rounds, sketch.repeated(rows.select("text"), hashes, max(sketch.SLICE_BITS, bits - (salt > 0)), salt)]
        held.unpersist()
    held = sc.broadcast(rounds)
    found = rows.select("doc", "key", "text").mapInArrow(lambda b: _found(b, width, held.value), _FOUND)
    # Parts by the first hash; the second one is compared inside them.
    found = found.repartition("h").withColumn("least", F.min("doc").over(Window.partitionBy("h", F.shiftright("place", 32))))
    removed = found.where(F.col("hi").isNotNull() | (F.col("doc") > F.col("least")))
    return removed.select("key", F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("lo"), "hi")


def _cut(batches: Iterator[pa.RecordBatch], width: int, texts_out: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, starts, ranges in zip(batch.column("text").to_pylist(), batch.column("starts"), batch.column("ranges"), strict=True):
            own = text.encode().split()
            n_words.append(len(own))
            if starts.is_valid:
                lo, hi = (ranges.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                alone = starts.values.to_numpy().astype(np.int64)
                lo, hi = words.merged(np.r_[lo, alone], np.r_[hi, alone] + width)
                n_removed.append(int((hi - lo).sum()))
                edges = np.r_[0, np.c_[lo, hi].ravel(), len(own)].tolist()
                own = [w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in own[a:b]]
            else:
                n_removed.append(0)
            rest = b" ".join(own)
            kept.append(rest.decode() if texts_out else hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "kept"])


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, texts: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_removed``, and the kept words joined by one space as
    ``kept_text`` (or their SHA-256 as ``kept_sha256``, with ``texts=False``)."""
    found = repeated_windows(docs, id_col, text_col, width)
    alone, whole = F.col("hi").isNull(), F.col("hi").isNotNull()
    lists = F.collect_list(F.when(alone, F.col("lo"))).alias("starts"), F.collect_list(F.when(whole, F.struct("lo", "hi"))).alias("ranges")
    joined = _keyed(docs, id_col, text_col).join(found.groupBy("key").agg(*lists), "key", "left").select("id", "text", "starts", "ranges")
    id_type = docs.schema[id_col].dataType.simpleString()
    out = joined.mapInArrow(lambda b: _cut(b, width, texts), f"id {id_type}, n_words long, n_removed long, kept string")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").alias("kept_text" if texts else "kept_sha256"))

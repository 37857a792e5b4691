"""SimHash near-dedup: fingerprints of word shingles, linked by pigeonhole blocks.

A fingerprint has a bit where over half of the shingles' XXH64 hashes have it. Two fingerprints that differ in at
most ``distance`` bits agree in at least two of ``distance + 2`` blocks, so fingerprints are joined on each pair of
blocks. Copies are one fingerprint. Inside a bucket no pairs are listed: members within one bit of a common value are
within two bits of each other, and any two that differ in two bits share such a value, so each member goes to its own
value and to those one bit away, and the members of a value are linked to its first one. For other distances the
members are verified pair by pair in blocks, in memory bounded by the bucket.

Null text is an empty text; texts without words have fingerprint zero and are linked like any other. Rows with the
same id are rows of their own with one node. A null id gets a null component. An empty table gives an empty result. Very
long texts are read whole. Other columns are not read, whatever their names, and come back unchanged
from ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm import words
from pulsegrid.llm.components import components
from pulsegrid.sources.scratch import cut

SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16
#: Rows of complete buckets compared at once.
BUCKET_ROWS = 20_000


def fingerprint(text: bytes, shingle: int) -> int:
    """Bits set in over half of the shingle hashes of a lower-cased text."""
    own = text.split()
    if not own:
        return 0
    joined, size = b" ".join(own), np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    last = max(0, len(own) - shingle)
    starts, ends = starts[: last + 1].tolist(), ends[min(shingle, len(own)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], ends[k : k + BLOCK], strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # Only the bytes of A to Z are changed: lower() on bytes knows no other letters.
        made = [fingerprint((x.as_buffer().to_pybytes() if x.is_valid else b"").lower(), shingle) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(np.array(made, np.uint64).view(np.int64))], names=["id", "key", "fp"])


def row_key(id_col: str, text_col: str) -> Column:
    """Key of a row: equal for rows of equal id and text."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id``, ``key``, ``fp``: 64-bit fingerprints as signed integers."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda b: _fingerprints(b, shingle), f"id {id_type}, key long, fp long")


def block_masks(distance: int) -> list[int]:
    """Masks of each pair of ``distance + 2`` blocks of 64 bits."""
    edges = [64 * k // (distance + 2) for k in range(distance + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [a | b for a, b in combinations(blocks, 2)]


def _links(bucket: np.ndarray, mask: np.ndarray, fp: np.ndarray, distance: int, masks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the members of each bucket as far as verified pairs do; ``bucket`` is sorted."""
    if distance == 2:
        a, b = [], []
        for k in np.unique(mask):
            rows = mask == k
            own, values = bucket[rows], fp[rows]
            free = [i for i in range(64) if not masks[k] >> i & 1]
            near = np.concatenate([values, *(values ^ np.uint64(1 << i) for i in free)])
            who = np.tile(np.arange(len(values)), len(free) + 1)
            order = np.lexsort((values[who], near, own[who]))
            near, who = near[order], who[order]
            new = np.r_[True, (near[1:] != near[:-1]) | (own[who][1:] != own[who][:-1])]
            first = who[np.flatnonzero(new)][np.cumsum(new) - 1]
            a.append(values[who])
            b.append(values[first])
        a, b = np.concatenate(a), np.concatenate(b)
        differ = a != b
        return a[differ], b[differ]
    a, b = [], []
    edges = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        for k in range(lo, hi, 1024):
            far = np.bitwise_count(fp[k : min(k + 1024, hi), None] ^ fp[None, lo:hi])
            i, j = np.nonzero((far <= distance) & (far > 0))
            a.append(fp[k + i])
            b.append(fp[lo + j])
    return np.concatenate(a), np.concatenate(b)


def _verify(batches: Iterator[pa.RecordBatch], distance: int, masks: list[int]) -> Iterator[pa.RecordBatch]:
    def out(rows: pa.Table) -> pa.RecordBatch:
        mask, key, fp = (rows[c].to_numpy() for c in ("mask", "bucket", "fp"))
        bucket = np.cumsum(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
        many = np.bincount(bucket)[bucket] > 1
        a, b = _links(bucket[many], mask[many], fp[many].view(np.uint64), distance, masks) if many.any() else (np.zeros(0, np.uint64),) * 2
        pairs = np.unique(np.c_[np.maximum(a, b), np.minimum(a, b)], axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], names=["a", "b"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < BUCKET_ROWS:
            continue
        rows = pa.Table.from_batches(held)
        mask, key = rows["mask"].to_numpy(), rows["bucket"].to_numpy()
        cut_at = int(np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])[-1])
        if cut_at:
            yield out(rows.slice(0, cut_at))
            rows = rows.slice(cut_at)
        held, n = rows.to_batches(), len(rows)
    if held:
        yield out(pa.Table.from_batches(held))


def _components(distinct: DataFrame, distance: int) -> DataFrame:
    """``distinct``, one row per ``fp``, with the ``component`` its fingerprint is in: the least fingerprint of it."""
    masks = block_masks(distance)
    keyed = distinct.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks))).alias("mask", "bucket"))
    buckets = keyed.repartition("mask", "bucket").sortWithinPartitions("mask", "bucket")
    links = buckets.mapInArrow(lambda b: _verify(b, distance, masks), "a long, b long")
    found = components(links, "simhash")
    return distinct.join(found, distinct["fp"] == found["node"], "left").withColumn("component", F.coalesce("component", "fp")).drop("node")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits), ``component_id`` (least id reachable) and ``row_key``, one row per row of ``docs``."""
    prints = cut(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    member = _components(prints.groupBy("fp").agg(F.min("id").alias("least")), distance)
    # Components of fingerprints get the least id of their documents.
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    # Written, so that both sides of the join are plain shuffles and a fingerprint of many copies can be split.
    named = cut(member.join(least, "component").select("fp", "component_id"), "members")
    out = prints.join(named, "fp")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.col("key").alias("row_key"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of each component, the one of the least id (nulls last), with the columns of ``docs``."""
    prints = cut(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    # The first row of each fingerprint is found in every task first, so copies don't meet.
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first")
    member = _components(prints.groupBy("fp").agg(first), distance)
    kept = member.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.key").alias("row_key"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_key(id_col, text_col).alias("row_key")).join(kept, "row_key")
    # Equal rows share a key; the first of them stays.
    number = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    return rows.withColumn("number", number).where("number = 1").select("row.*")

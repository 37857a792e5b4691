"""Suffix-array dedup by prefix-free parsing: every byte of a repeated string of ``length`` bytes is removed.

Rolling-hash triggers cut the bytes into phrases: a position is a trigger if its hash is the least of ``SPAN``
consecutive positions, so any string of ``length`` bytes holds a trigger that its own bytes fix, and equal strings
hold it at the same place. A string is then a suffix of the phrase that ends at its trigger, followed by what the
parse goes on with. Both sides are sorted: the dictionary of phrases from their ends (suffix order), and what follows
the trigger in the order of the parse. Two strings are neighbours in corpus order and equal as far as ``length`` if
and only if they share both the range of phrases with that suffix and the range of continuations with that prefix.

The corpus order is built in parts: all strings that share the trigger and the bytes that follow it in any case lie
in one part, and a first pass (``sketch.py``) keeps home the triggers whose following bytes occur once. A document
whose phrase and surroundings were met before in its batch of documents is settled there; one row goes on.

Texts are UTF-8 bytes; matches never cross documents; null text is empty. Rows with the same id and text count as
separate documents. An empty table gives an empty result. Very long texts are read whole. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm import sketch, words
from pulsegrid.sources.scratch import cut

#: Bytes of one rolling hash, and positions among which the least hash is a trigger.
GRAM, SPAN = 8, 100
#: Bytes scanned at once; triggers found in a batch of this size are compared before any leaves it.
SCAN_BYTES, BATCH_BYTES = 1 << 21, 24 << 20
#: Rows of a part of the corpus order held at once; a larger part is compared through its strings' hashes, so many rows
#: at a time, and equal hashes meet in a shuffle.
PART_ROWS = 100_000
STRING_ROWS = 10_000
_NEAR = pa.schema([("part", pa.int64()), ("tag", pa.int32()), ("whole", pa.int64()), ("n", pa.int8()), ("key", pa.int64()), ("at", pa.int32()), ("left", pa.binary()), ("right", pa.binary()), ("far", pa.int16()), ("near", pa.int16())])
_NEAR_SQL = "part long, tag int, whole long, n byte, key long, at int, left binary, right binary, far short, near short"
#: Ranges lo to hi of starts to remove; or, with a hash, strings still to be compared (lo, hi: one start).
_OUT = pa.schema([("h", pa.int64()), ("tag", pa.int32()), ("n", pa.int8()), ("key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
_OUT_SQL = "h long, tag int, n byte, key long, lo int, hi int"


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` consecutive values."""
    n = len(values) - span + 1
    if n <= 0:
        return values[:0]
    rows = -(-len(values) // span)
    grid = np.full(rows * span, np.iinfo(values.dtype).max, values.dtype)
    grid[: len(values)] = values
    grid = grid.reshape(rows, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])


def triggers(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """First start, last start and trigger of each run of strings with one trigger, as places in ``data``."""
    for a in range(0, max(0, len(data) - length + 1), SCAN_BYTES):
        b = min(len(data), a + SCAN_BYTES + length - 1)
        part = data[a:b].astype(np.uint64)
        h = np.zeros(len(part) - GRAM + 1, np.uint64)
        for k in range(GRAM):
            h |= part[k : k + len(h)] << np.uint64(8 * k)
        # Equal hashes: the first place is the trigger.
        h = (words.mix(h) >> np.uint64(22)) << np.uint64(22) | np.arange(len(h), dtype=np.uint64)
        at = (_least(h, SPAN) & np.uint64((1 << 22) - 1)).astype(np.int64)[: len(part) - length + 1]
        room = np.maximum(bounds[1:] - (length - 1), bounds[:-1])
        edges = np.zeros(len(at) + 1, np.int32)
        np.add.at(edges, np.clip(bounds[:-1] - a, 0, len(at)), 1)
        np.add.at(edges, np.clip(room - a, 0, len(at)), -1)
        ok = np.cumsum(edges[:-1]) > 0
        i = np.flatnonzero(ok)
        if not len(i):
            continue
        t = at[i]
        new = np.r_[True, (t[1:] != t[:-1]) | (i[1:] != i[:-1] + 1)]
        # A trigger that two documents would share lies in one of them only: runs never touch across documents.
        first = i[new]
        last = np.r_[i[np.flatnonzero(new)[1:] - 1], i[-1]]
        yield first + a, last + a, t[new] + a


def _parts(data: np.ndarray, t: np.ndarray, length: int) -> np.ndarray:
    """Hash of the bytes from each trigger that every string with that trigger holds."""
    return words.range_hashes(data, t, t + length - SPAN + 1)


def _scan(texts: pa.Array, length: int) -> tuple[np.ndarray, ...]:
    data, bounds = words.raw(texts)
    found = list(triggers(data, bounds, length))
    first, last, t = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    return data, bounds, first, last, t, _parts(data, t, length)


def _ranges(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts lo to hi by key, joined where they touch."""
    order = np.lexsort((lo, key))
    key, lo, hi = key[order], lo[order], hi[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (lo[1:] > hi[:-1] + 1)][: len(key)]
    return key[new], lo[new], np.maximum.reduceat(hi, np.flatnonzero(new)) if len(hi) else hi


def _near(batches: Iterator[pa.RecordBatch], length: int, bitmaps: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        part, tag, whole, key, at, far, near, left, right = map(np.concatenate, zip(*held, strict=True))
        order = np.lexsort((whole, tag, part))
        same = np.r_[False, (part[order][1:] == part[order][:-1]) & (tag[order][1:] == tag[order][:-1]) & (whole[order][1:] == whole[order][:-1])][: len(order)]
        heads = np.flatnonzero(~same)
        count = np.diff(np.r_[heads, len(order)])
        many = np.repeat(count > 1, count)
        settled = order[many]
        k_key, k_lo, k_hi = _ranges(key[settled], at[settled] - far[settled], at[settled] - near[settled])
        rest, m = order[heads], len(k_key)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[part[rest].view(np.int64), k_key]),
                pa.array(np.r_[tag[rest], np.full(m, -1, np.int32)]),
                pa.array(np.r_[whole[rest].view(np.int64), k_key]),
                pa.array(np.r_[np.minimum(count, 2), np.full(m, 2)].astype(np.int8)),
                pa.array(np.r_[key[rest], k_key]),
                pa.array(np.r_[at[rest], k_lo].astype(np.int32)),
                pa.array([*left[rest], *[None] * m], pa.binary()),
                # A settled range: its last start, as bytes, in place of what follows a trigger.
                pa.array([*right[rest], *(x.tobytes() for x in k_hi.astype(np.int32))], pa.binary()),
                pa.array(np.r_[far[rest], np.zeros(m)].astype(np.int16)),
                pa.array(np.r_[near[rest], np.zeros(m)].astype(np.int16)),
            ],
            schema=_NEAR,
        )

    for batch in batches:
        texts, keys = words.texts_of(batch, "text"), batch.column("key").to_numpy()
        for lo, hi in words.groups(texts):
            data, bounds, first, last, t, part = _scan(texts[lo:hi], length)
            maybe = sketch.maybe_repeated(part, bitmaps)
            first, last, t, part = first[maybe], last[maybe], t[maybe], part[maybe]
            size += len(data)
            if len(t):
                tail = t + length - SPAN + 1
                tag = (words.mix(words.range_hashes(data, t, np.minimum(t + GRAM, tail)) ^ part, 77) >> np.uint64(33)).astype(np.int32)
                whole = words.mix(words.range_hashes(data, first, last + length) ^ ((t - first) << 16 | (t - last)).astype(np.uint64))
                text = np.searchsorted(bounds, t, "right") - 1
                blob = data.tobytes()
                left, right = np.empty(len(t), object), np.empty(len(t), object)
                left[:] = [blob[a:b] for a, b in zip(first.tolist(), t.tolist(), strict=True)]
                right[:] = [blob[a:b] for a, b in zip(tail.tolist(), (last + length).tolist(), strict=True)]
                held.append((part, tag, whole, keys[text + lo], t - bounds[text], t - first, t - last, left, right))
            if size >= BATCH_BYTES and held:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _padded(values: pa.Array, width: int, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of a matrix (each from its end, if ``backward``), and their lengths."""
    values = values.cast(pa.large_binary())
    data, bounds = words.raw(values)
    n = np.diff(bounds)
    out = np.zeros((len(n), width), np.uint8)
    row = np.repeat(np.arange(len(n)), n)
    col = np.arange(len(data)) - bounds[row]
    if backward:
        col = n[row] - 1 - col
    out[row, col] = data
    return out, n


def _order(group: np.ndarray, rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows inside their groups, and how far each agrees with the one before (-1: another group)."""
    width = -(-rows.shape[1] // 8) * 8
    wide = np.zeros((len(rows), width), np.uint8)
    wide[:, : rows.shape[1]] = rows
    order = np.lexsort((*wide.view(">u8").T[::-1], group))
    a, b = order[:-1], order[1:]
    differs = rows[a] != rows[b]
    agree = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    agree = np.minimum(agree, np.minimum(n[a], n[b]))
    return order, np.r_[-1, np.where(group[a] == group[b], agree, -1)][: len(order)]


def corpus_order(group: np.ndarray, left: pa.Array, right: pa.Array, far: np.ndarray, near: np.ndarray, weight: np.ndarray, width: int) -> np.ndarray:
    """Which strings are repeated: a matrix of rows and distances before the trigger, ``width`` of them.

    ``left`` is the phrase up to the trigger, ``right`` what follows the bytes all rows of a group share. The string
    at distance a is the phrase's suffix of a bytes and the first ``width - 1 - a`` bytes of ``right``.
    """
    n = len(group)
    found = np.zeros((n, width), bool)
    phrase_order, suffix = _order(group, *_padded(left, width, True))
    parse_order, prefix = _order(group, *_padded(right, width, False))
    by_phrase, by_parse = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(width):
        # Rows that agree in at least a bytes of the phrase, and in what follows, have one number each.
        by_phrase[phrase_order] = np.cumsum(suffix < a)
        by_parse[parse_order] = np.cumsum(prefix < width - 1 - a)
        rows = np.flatnonzero((near <= a) & (a <= far))
        both = by_phrase[rows] * (n + 1) + by_parse[rows]
        order = np.argsort(both, kind="stable")
        new = np.flatnonzero(np.r_[True, both[order][1:] != both[order][:-1]][: len(order)])
        total = np.add.reduceat(weight[rows][order], new) if len(new) else np.zeros(0, int)
        found[rows[order], a] = np.repeat(total > 1, np.diff(np.r_[new, len(order)]))
    return found


def _starts(found: np.ndarray, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Found strings as ranges of starts."""
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, near = np.nonzero(edge == 1)
    far = np.nonzero(edge == -1)[1] - 1
    return key[row], at[row] - far, at[row] - near


def _result(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    m = len(key)
    return pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int8()), pa.array(key), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], schema=_OUT)


def _strings(rows: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    """Every string of these rows by its hash, for parts too large for one task: equal ones of these rows are settled
    here, and one of them goes on."""
    base = np.uint64(0xA0761D6478BD642F)
    left, _ = _padded(rows["left"].combine_chunks(), width, True)
    right, _ = _padded(rows["right"].combine_chunks(), width, False)
    seed = rows["part"].to_numpy().view(np.uint64) ^ rows["tag"].to_numpy().astype(np.uint64) << np.uint64(32)
    sides = []
    for side, salt in ((left, 11), (right, 23)):
        out, h = np.zeros((len(side), width), np.uint64), words.mix(seed, salt)
        for a in range(width):
            out[:, a] = h
            h = words.mix(h * base + side[:, a].astype(np.uint64) + np.uint64(1), salt)
        sides.append(out)
    far, near, span = rows["far"].to_numpy(), rows["near"].to_numpy(), np.arange(width)
    row, a = np.nonzero((near[:, None] <= span) & (span <= far[:, None]))
    before, after = sides[0][row, a], sides[1][row, width - 1 - a]
    h = words.mix(before * base + after + a.astype(np.uint64))
    tag = (words.mix(before + after * base, 5) >> np.uint64(33)).astype(np.int32)
    key, start, n = rows["key"].to_numpy()[row], rows["at"].to_numpy()[row].astype(np.int64) - a, rows["n"].to_numpy()[row].astype(np.int64)
    order = np.lexsort((tag, h))
    heads = np.flatnonzero(np.r_[True, (h[order][1:] != h[order][:-1]) | (tag[order][1:] != tag[order][:-1])][: len(order)])
    if not len(heads):
        return
    total = np.add.reduceat(n[order], heads)
    met = order[np.repeat(total > 1, np.diff(np.r_[heads, len(order)]))]
    yield _result(*_ranges(key[met], start[met], start[met]))
    one = order[heads]
    place = pa.array(start[one].astype(np.int32))
    yield pa.RecordBatch.from_arrays([pa.array(h[one].view(np.int64)), pa.array(tag[one]), pa.array(np.minimum(total, 2).astype(np.int8)), pa.array(key[one]), place, place], schema=_OUT)


def _part(rows: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    """All strings of complete parts."""
    done = rows["tag"].to_numpy() == -1
    if done.any():
        own = rows.filter(pa.array(done))
        last = np.frombuffer(b"".join(own["right"].to_pylist()), np.int32)
        yield _result(own["key"].to_numpy(), own["at"].to_numpy(), last)
        rows = rows.filter(pa.array(~done))
    if not len(rows):
        return
    part, tag, whole = (rows[c].to_numpy() for c in ("part", "tag", "whole"))
    order = np.lexsort((whole, tag, part))
    new = np.r_[True, (part[order][1:] != part[order][:-1]) | (tag[order][1:] != tag[order][:-1])]
    own = np.r_[True, new[1:] | (whole[order][1:] != whole[order][:-1])]
    heads = np.flatnonzero(own)
    total = np.add.reduceat(rows["n"].to_numpy()[order].astype(np.int64), heads)
    size = np.diff(np.r_[heads, len(order)])
    key, at, far, near = (rows[c].to_numpy().astype(np.int64) for c in ("key", "at", "far", "near"))
    met = order[np.repeat(total > 1, size)]
    yield _result(key[met], at[met] - far[met], at[met] - near[met])
    # One row for each phrase and surroundings; parts with only one of them have nothing more to compare.
    group = np.cumsum(new)[heads]
    several = np.bincount(group)[group] > 1
    if several.any():
        head, group, weight = order[heads[several]], group[several], np.minimum(total[several], 2)
        own = rows.select(["left", "right"]).take(pa.array(head))
        found = corpus_order(group, own["left"].combine_chunks(), own["right"].combine_chunks(), far[head], near[head], weight, width)
        found &= (weight < 2)[:, None]
        yield _result(*_starts(found, key[head], at[head]))


def _order_parts(batches: Iterator[pa.RecordBatch], width: int, part_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part: complete parts are handled together, a part larger than ``part_rows`` as strings."""
    held: list[pa.RecordBatch] = []
    n, large = 0, None

    def handle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Rows up to the end of a part."""
        rest = 0
        if large is not None:
            rest = int(np.searchsorted(rows["part"].to_numpy(), large, "right"))
            for k in range(0, rest, STRING_ROWS):
                yield from _open_rows(rows.slice(k, min(STRING_ROWS, rest - k)), width)
        if rest < len(rows):
            yield from _part(rows.slice(rest), width)

    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < part_rows:
            continue
        rows = pa.Table.from_batches(held)
        part = rows["part"].to_numpy()
        cut = int(np.searchsorted(part, part[-1], "left"))
        if cut:
            yield from handle(rows.slice(0, cut))
            rows, large = rows.slice(cut), None if part[-1] != large else large
        if len(rows) >= part_rows:
            large = part[-1]
            yield from handle(rows)
            rows = rows.slice(0, 0)
        held, n = rows.to_batches(), len(rows)
    if held:
        yield from handle(pa.Table.from_batches(held))


def _open_rows(rows: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of a large part: settled ranges as they are, the others as strings."""
    done = pa.array(rows["tag"].to_numpy() == -1)
    yield from _part(rows.filter(done), width)
    rows = rows.filter(pc.invert(done))
    if len(rows):
        met = rows.filter(pa.array(rows["n"].to_numpy() > 1))
        at, far, near = (met[c].to_numpy().astype(np.int64) for c in ("at", "far", "near"))
        yield _result(met["key"].to_numpy(), at - far, at - near)
        yield from _strings(rows, width)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_col), text).alias("key"), F.col(id_col).alias("id"), text.alias("text"))


def repeated_starts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, part_rows: int = PART_ROWS) -> DataFrame:
    """Rows ``key``, ``lo``, ``hi``: strings that start at bytes lo to hi of the document of that key occur elsewhere."""
    if length < SPAN + 2 * GRAM:
        raise ValueError(f"length is at least {SPAN + 2 * GRAM}")
    rows = _keyed(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def parts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        texts = words.texts_of(batch, "text")
        for lo, hi in words.groups(texts):
            yield _scan(texts[lo:hi], length)[-1]

    # Triggers are SPAN / 2 bytes apart on average; the bitmaps' size is bounded by sketch.MAX_BITS.
    bitmaps = docs.sparkSession.sparkContext.broadcast(sketch.repeated(rows.select("text"), parts, sketch.bits_for(size // (SPAN // 2))))
    near = rows.select("key", "text").mapInArrow(lambda b: _near(b, length, bitmaps.value), _NEAR_SQL)
    parts = near.repartition("part").sortWithinPartitions("part", "tag").mapInArrow(lambda b: _order_parts(b, SPAN, part_rows), _OUT_SQL)
    parts = cut(parts, "repeats")
    total = F.sum("n").over(Window.partitionBy("h", "tag"))
    large = parts.where("h IS NOT NULL").withColumn("total", total).where("total > 1")
    return parts.where("h IS NULL").select("key", "lo", "hi").union(large.select("key", "lo", "hi"))


def _kept(texts: pa.Array, ranges: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, bytes]]:
    """Number of bytes, removed ranges and what is left of each text."""
    for text, found in zip(texts, ranges, strict=True):
        own = text.as_buffer().to_pybytes() if text.is_valid else b""
        n, lo, hi = len(own), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if found.is_valid:
            lo, hi = (found.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            lo, hi = words.merged(lo, hi + length)
            edges = np.r_[0, np.c_[lo, hi].ravel(), n].tolist()
            own = b"".join([own[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
        yield n, lo, hi, own


def _digests(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [(n, int((hi - lo).sum()), len(lo), hashlib.sha256(own).hexdigest()) for n, lo, hi, own in _kept(batch.column("text"), batch.column("ranges"), length)]
        numbers = np.array([m[:3] for m in made], np.int64).reshape(-1, 3).T
        yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, numbers), pa.array([m[3] for m in made], pa.string())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _by_document(docs: DataFrame, id_col: str, text_col: str, length: int, part_rows: int = PART_ROWS) -> DataFrame:
    return repeated_starts(docs, id_col, text_col, length, part_rows).groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    joined = _keyed(docs, id_col, text_col).join(_by_document(docs, id_col, text_col, length, part_rows), "key", "left").select("id", "text", "ranges")
    id_type = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(lambda b: _digests(b, length), f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """``docs`` with repeated bytes cut out of the texts; a character cut apart goes with them. Null texts become empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.col(id_col), text).alias("key"))
    joined = rows.join(_by_document(docs, id_col, text_col, length), "key", "left").select("row", "ranges")
    place = docs.columns.index(text_col)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            fields = [row.field(k) for k in range(row.type.num_fields)]
            kept = [own.decode(errors="ignore") for *_, own in _kept(fields[place], batch.column("ranges"), length)]
            fields[place] = pa.array(kept, row.type.field(place).type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=list(row.type))], names=["row"])

    return joined.mapInArrow(cut_out, joined.select("row").schema).select("row.*")

"""Best-fit packing of token sequences by bin completion.

Texts become token ids; only texts longer than a sequence are cut, into full pieces with the shorter one first. Pieces
are dealt by a hash into lots of about ``LOT`` documents, so a lot fits a task at any size of the corpus and the
sequences a lot loses against the whole are a small part of it. A lot is packed on the counts of its lengths: best fit
decreasing gives the first incumbent; if it has more sequences than the lower bound, branch and bound completes one
sequence after the other around the longest piece left, over the fillings that no other filling dominates, fullest
first, and gives up a branch when its waste exceeds what a better solution may waste. ``NODES`` bounds the search of a
lot; the incumbent stands then.

Null text is empty: one end token. Rows with the same id are packed as they are, each with its own pieces; a null id
is kept. An empty table gives an empty result. Equal rows (same id and text) share a lot. Very long texts are many pieces
of one document. Other columns are not read, whatever their names. ``BRANCHES`` fillings at most, of up to four pieces with
the longest one, are tried around a piece.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = 2
LOT = 8192
#: Completed sequences tried in a lot's search.
NODES = 30_000
#: Fillings kept around one piece.
BRANCHES = 6


@lru_cache(2)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file: its vocabulary's order is its merges' order."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {x["content"] for x in model["added_tokens"]}
    # The alphabet of byte-level vocabularies: printable bytes are themselves, the others follow from 256 on.
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in plain]
    alphabet = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={x["content"]: x["id"] for x in model["added_tokens"]})


def token_ids(text: str, path: str, end: int = END, special: bool = False) -> np.ndarray:
    """Little-endian 32-bit ids, with the end token; names of special tokens in a text are ordinary text, or with ``special`` their
    tokens, as ``tokenizers`` has them by default."""
    ids = encoding(path).encode_to_numpy(text, allowed_special="all" if special else set(), disallowed_special=())
    return np.append(ids, np.uint32(end)).astype("<u4")


def _pieces(batches: Iterator[pa.RecordBatch], path: str, length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, piece, start, size, crc, ids = [], [], [], [], [], []
        for k, text in enumerate(batch.column("text")):
            own = token_ids(text.as_py() or "", path, special=True)
            first = len(own) % length or length
            edges = [0, *range(first, len(own) + 1, length)]
            for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                row.append(k)
                piece.append(n)
                start.append(a)
                size.append(b - a)
                crc.append(zlib.crc32(own[a:b].data))
                if with_ids:
                    ids.append(own[a:b].astype(np.int32))
        columns = [batch.column("id").take(pa.array(row, pa.int64())), batch.column("lot").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
        columns += [pa.array(x, pa.int64()) for x in (start, size, crc)]
        names = ["id", "lot", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Sequences any packing needs: total length, and pieces too long to share with those of at least k."""
    lengths = np.arange(capacity + 1)
    total = count * lengths
    best = -(-int(total.sum()) // capacity)
    for k in range(1, capacity // 2 + 1):
        alone, half = capacity - k, capacity // 2
        big, middle = count[alone + 1 :].sum(), count[half + 1 : alone + 1].sum()
        small = total[k : half + 1].sum() - (middle * capacity - total[half + 1 : alone + 1].sum())
        best = max(best, int(big + middle) + max(0, -(-int(small) // capacity)))
    return best


def best_fit(count: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit decreasing: each piece goes where the least room is left."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0
    for size in range(capacity, 0, -1):
        for _ in range(int(count[size])):
            fits = open_rooms >> size
            if fits:
                left = size + (fits & -fits).bit_length() - 1
                number = room[left].pop()
                if not room[left]:
                    open_rooms &= ~(1 << left)
                bins[number].append(size)
                left -= size
            else:
                number, left = len(bins), capacity - size
                bins.append([size])
            if left:
                room[left].append(number)
                open_rooms |= 1 << left
    return bins


def _largest(mask: int, limit: int) -> int:
    """Largest length present up to ``limit``, or 0; bit k of ``mask`` stands for length k."""
    return max(0, (mask & ((2 << limit) - 1)).bit_length() - 1) if limit > 0 else 0


def fillings(mask: int, count: list[int], room: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, fullest first: a longest single piece, pairs, and triples.

    A filling is left out if another one could hold all of it piece by piece: the second piece is the longest that
    fits beside the first, and several pieces that would fit into one that is there don't replace it.
    """
    single = _largest(mask, room)
    if not single:
        return [()]
    found = [(single,)]
    if single == room:
        return found
    x, seen = single, room + 1
    while 2 * x > single:
        rest = room - x
        limit = min(x, rest)
        y = _largest(mask, limit)
        if y == x and count[x] < 2:
            y = _largest(mask, x - 1 if x <= rest else limit)
        if y and x + y > single and y < seen:
            found.append((x, y))
            seen = y
            if x + y == room:
                break
            third = _largest(mask, min(y, rest - y))
            if third and count[third] >= 1 + (third == y) + (third == x):
                found[-1] = (x, y, third)
        x = _largest(mask, x - 1)
        if len(found) > 64:
            break
    found.sort(key=sum, reverse=True)
    return found[:BRANCHES]


def complete(count: np.ndarray, capacity: int, incumbent: list[list[int]], bound: int) -> list[list[int]]:
    """Bin completion: depth first over the fillings around the longest piece, with the waste a better packing allows."""
    left = [int(x) for x in count]
    total = sum(k * n for k, n in enumerate(left))
    mask = sum(1 << k for k, n in enumerate(left) if n and k)
    best = incumbent
    allowed = (len(best) - 1) * capacity - total
    path: list[tuple[tuple[int, ...], list[tuple[int, ...]], int]] = []
    waste = nodes = 0

    def take(pieces: tuple[int, ...], step: int) -> None:
        nonlocal mask
        for p in pieces:
            left[p] -= step
            mask = mask | 1 << p if left[p] else mask & ~(1 << p)

    def options() -> list[tuple[int, ...]]:
        longest = mask.bit_length() - 1
        take((longest,), 1)
        out = [(longest, *f) for f in fillings(mask, left, capacity - longest)]
        take((longest,), -1)
        return out[::-1]

    todo = options()
    while nodes < NODES:
        nodes += 1
        pick = None
        while todo:
            pick = todo.pop()
            lost = capacity - sum(pick)
            if waste + lost <= allowed:
                break
            pick = None
        if pick is None:
            if not path:
                return best
            last, todo, lost = path.pop()
            take(last, -1)
            waste -= lost
            continue
        take(pick, 1)
        waste += lost
        path.append((pick, todo, lost))
        if mask:
            todo = options()
            continue
        best = [list(p) for p, _, _ in path]
        allowed = (len(best) - 1) * capacity - total
        if len(best) <= bound:
            return best
        todo = []
    return best


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece."""
    count = np.bincount(lengths, minlength=capacity + 1)
    full = int(count[capacity])
    count[capacity] = 0
    bins = best_fit(count, capacity)
    bound = lower_bound(count, capacity)
    if len(bins) > bound:
        bins = complete(count, capacity, bins, bound)
    by_length = np.argsort(lengths, kind="stable")
    # Places of each length's pieces in that order; they are handed out one after the other.
    place = np.r_[0, np.cumsum(np.bincount(lengths, minlength=capacity + 1))][:-1].tolist()
    number, offset, order = [], [], []
    for k, pieces in enumerate(bins):
        at = 0
        for p in pieces:
            order.append(place[p])
            place[p] += 1
            number.append(k)
            offset.append(at)
            at += p
    order += range(place[capacity], place[capacity] + full)
    number += range(len(bins), len(bins) + full)
    offset += [0] * full
    out = np.empty((2, len(lengths)), np.int64)
    out[:, by_length[np.array(order, np.int64)]] = number, offset
    return out[0], out[1]


def _pack_lot(rows: pa.Table, capacity: int) -> pa.Table:
    number, offset = pack(rows["length"].to_numpy(), capacity)
    number += rows["lot"][0].as_py() << 32
    return rows.drop(["lot"]).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 1024, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``, (``ids``,) ``sequence_id``, ``offset``."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    lots = max(1, round(docs.count() / LOT))
    id_type = docs.schema[id_col].dataType.simpleString()
    ids = "ids array<int>, " if with_ids else ""
    kept = f"piece int, start long, length long, ids_crc32 long, {ids}"
    # Rows with one id, or without any, still spread over the lots.
    rows = docs.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(id_col, text_col), F.lit(lots)).alias("lot"), F.col(text_col).alias("text"))
    pieces = rows.mapInArrow(lambda b: _pieces(b, path, length, with_ids), f"id {id_type}, lot long, {kept}".rstrip(", "))
    packed = pieces.groupBy("lot").applyInArrow(lambda t: _pack_lot(t, length), f"id {id_type}, {kept}sequence_id long, offset long")
    return packed.withColumnRenamed("id", id_col)

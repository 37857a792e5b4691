"""Words and byte hashes of many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Word separators: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

#: Texts are handled in groups of about this many bytes; one longer text is a group of its own.
GROUP_BYTES = 1 << 20
#: Hashes of words are made from stretches of about this many bytes.
STRETCH_BYTES = 1 << 19

_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, kept up to a stretch."""
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        size = max(n, STRETCH_BYTES + 1)
        kept = np.full(size, base % (1 << 64), np.uint64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if n <= 4 * STRETCH_BYTES:
            _powers[base] = kept
    return kept[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ np.uint64(salt)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column with nulls as empty texts and 64-bit offsets."""
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def groups(texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(ends):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield lo, hi
        lo = hi


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and each text's bounds among them."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    gap = SPACE[data]
    first, last = np.empty(len(data), bool), np.empty(len(data), bool)
    first[0] = last[-1] = True
    first[1:] = gap[:-1]
    last[:-1] = gap[1:]
    first[bounds[:-1][bounds[:-1] < len(data)]] = True
    last[bounds[1:] - 1] = True
    starts, ends = np.flatnonzero(first & ~gap), np.flatnonzero(last & ~gap) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; the ranges are in order of their starts and may overlap."""
    out = np.empty(len(starts), np.uint64)
    lo, back = 0, inverse(_BASE)
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + STRETCH_BYTES, "left")))
        a, b = starts[lo], ends[lo:hi].max()
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE[data[a:b]] * powers(_BASE, b - a), out=sums[1:])
        out[lo:hi] = (sums[ends[lo:hi] - a] - sums[starts[lo:hi] - a]) * powers(back, b - a + 1)[starts[lo:hi] - a]
        lo = hi
    return mix(out ^ (ends - starts).astype(np.uint64))


#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes mixed in at a time; hashes of two salts are independent.

    Ranges of up to eight bytes have the same hash only if they are equal. No polynomial: texts built so that powers of
    any base cancel out have hashes as different as others.
    """
    size = ends - starts
    loads = np.ndarray((len(data) + 1,), "<u8", np.r_[data, np.zeros(8, np.uint8)].tobytes(), strides=(1,))
    out = mix(size.astype(np.uint64), salt)
    todo, at = np.flatnonzero((size > 0) & (size <= LONG_WORD)), 0
    while len(todo):
        left = size[todo] - at
        out[todo] = mix(out[todo] ^ (loads[starts[todo] + at] & _MASKS[np.minimum(left, 8)]), salt)
        todo, at = todo[left > 8], at + 8
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes(), salt)
    return out


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of each ``width`` consecutive values (none if there are fewer)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = 1
    for k in range(width):
        out += values[k : k + n] * np.uint64(factor)
        factor = factor * base % (1 << 64)
    return mix(out)


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges, as sorted ranges that neither overlap nor touch."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.r_[True, lo[1:] > hi[:-1]]
    return lo[new], hi[np.r_[new[1:], True]]

"""Which hashes occur at least twice: sketches of partitions, merged by ranges of cells into one bitmap.

Each hash has ``ROWS`` cells. A partition's sketch is the sorted list of its cells, each at most twice, as gaps of
one byte. Merging adds the counts up to two. A hash whose every cell counts two may be repeated; one with a cell
below two is not, so none is lost. The bitmap has a fixed upper size, so it may be broadcast. A second round over the hashes that the first can't rule out, with other cells, leaves few that occur once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsegrid.llm.words import mix

ROWS = 2
#: Cells of one slice of the sketch, as a power of two.
SLICE_BITS = 20
#: Largest number of cells of a row, as a power of two: two bitmaps of 32 MB.
MAX_BITS = 28
#: A partition writes its sketch out after so many hashes.
FLUSH = 4_000_000

_SCHEMA = "line int, slice int, gaps binary"
_ARROW = pa.schema([("line", pa.int32()), ("slice", pa.int32()), ("gaps", pa.binary())])


def bits_for(expected: int) -> int:
    """Bits of a cell number for so many hashes: about two cells each, within the bounds."""
    return min(MAX_BITS, max(SLICE_BITS, int(2 * expected).bit_length()))


def _cells(hashes: np.ndarray, line: int, bits: int, salt: int = 0) -> np.ndarray:
    hashes = mix(hashes, salt) if salt else hashes
    return ((hashes >> np.uint64(32 * line)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def pack_gaps(cells: np.ndarray) -> bytes:
    """Sorted numbers as gaps; a byte 255 means 255 more."""
    gaps = np.diff(cells.astype(np.int64), prepend=0)
    more = gaps // 255
    out = np.full(len(gaps) + more.sum(), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = gaps % 255
    return out.tobytes()


def unpack_gaps(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(blob, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def _sketch_of(hashes: np.ndarray, bits: int, salt: int) -> pa.RecordBatch:
    lines, slices, blobs = [], [], []
    for line in range(ROWS):
        cells = np.sort(_cells(hashes, line, bits, salt))
        cells = cells[np.r_[np.ones(min(2, len(cells)), bool), cells[2:] != cells[:-2]]]
        cuts = np.searchsorted(cells, np.arange(0, (1 << bits) + 1, 1 << SLICE_BITS, dtype=np.int64))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                lines.append(line)
                slices.append(k)
                blobs.append(pack_gaps(cells[a:b] - np.uint32(k << SLICE_BITS)))
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.int32()), pa.array(slices, pa.int32()), pa.array(blobs, pa.binary())], schema=_ARROW)


def repeated(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, salt: int = 0) -> list[np.ndarray]:
    """Bitmaps of the cells that count at least two, over the hashes of all ``rows``."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for hashes in hashes_of(batch):
                held.append(hashes)
                n += len(hashes)
                if n >= FLUSH:
                    yield _sketch_of(np.concatenate(held), bits, salt)
                    held, n = [], 0
        if n:
            yield _sketch_of(np.concatenate(held), bits, salt)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for line, part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                count = counts.setdefault((line, part), np.zeros(1 << SLICE_BITS, np.uint8))
                cells = unpack_gaps(blob)
                again = np.r_[False, cells[1:] == cells[:-1]]
                count[cells[~again]] += 1
                count[cells[again]] += 1
                count[cells] = np.minimum(count[cells], 2)
        for (line, part), count in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([line], pa.int32()), pa.array([part], pa.int32()), pa.array([np.packbits(count >= 2, bitorder="little").tobytes()], pa.binary())],
                schema=_ARROW,
            )

    out = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(ROWS)]
    size = 1 << (SLICE_BITS - 3)
    merged = rows.mapInArrow(sketch, _SCHEMA).repartition("line", "slice").mapInArrow(merge, _SCHEMA)
    # At most ROWS << (MAX_BITS - 3) bytes reach the driver, whatever the input.
    for line, part, blob in zip(*(c.to_pylist() for c in merged.toArrow().columns), strict=True):
        out[line][part * size : (part + 1) * size] = np.frombuffer(blob, np.uint8)
    return out


def maybe_repeated(hashes: np.ndarray, bitmaps: list[np.ndarray], salt: int = 0) -> np.ndarray:
    bits = len(bitmaps[0]).bit_length() + 2
    out = np.ones(len(hashes), bool)
    for line, bitmap in enumerate(bitmaps):
        cells = _cells(hashes, line, bits, salt)
        out &= (bitmap[cells >> np.uint32(3)] >> (cells & np.uint32(7)).astype(np.uint8)) & 1 == 1
    return out

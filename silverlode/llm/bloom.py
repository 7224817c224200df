"""A pair of Bloom filters, of hashes seen once and seen twice, built by many tasks.

Tasks turn their hashes into cells of one large bit array, cut into segments. Segments meet by key and
merge pairwise: a cell is seen twice if either part saw it twice or both saw it. A hash that occurs twice
has all its cells set in the second filter; other hashes have them by chance only.

The size is bounded by a parameter, so the merged filter may be collected and broadcast. Beyond the
bound it fills up: more hashes pass than need to, none is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT_CELLS = 1 << 18
HASHES = 4
#: Parts of a segment that one task merges.
FAN_IN = 64
_SCHEMA = "segment int, part int, once binary, twice binary"


def cells_for(n: int, max_cells: int) -> int:
    """A power of two with at least eight cells for each of ``n`` hashes, up to ``max_cells``."""
    return int(min(max(SEGMENT_CELLS, 1 << max(0, 8 * n - 1).bit_length()), max_cells))


def cells_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each unsigned 64-bit hash, one row for each of the hash functions."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(k) * step) & np.uint64(cells - 1) for k in range(HASHES)])


def contains(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether all cells of each hash are set in a filter of packed bits."""
    held = np.ones(len(hashes), bool)
    for cell in cells_of(hashes, 8 * len(bits)):
        held &= (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return held


def _pack(cells: np.ndarray) -> bytes:
    bits = np.zeros(SEGMENT_CELLS, bool)
    bits[cells] = True
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def _parts(cells: np.ndarray, part: int) -> Iterator[pa.RecordBatch]:
    cells, counts = np.unique(cells, return_counts=True)
    segments = cells // SEGMENT_CELLS
    cuts = np.flatnonzero(np.diff(segments, prepend=-1))
    for start, end in zip(cuts, [*cuts[1:], len(cells)], strict=True):
        local = cells[start:end] % SEGMENT_CELLS
        yield pa.RecordBatch.from_pydict(
            {
                "segment": pa.array([int(segments[start])], pa.int32()),
                "part": pa.array([part], pa.int32()),
                "once": pa.array([_pack(local)], pa.binary()),
                "twice": pa.array([_pack(local[counts[start:end] > 1])], pa.binary()),
            }
        )


def _merge(table: pa.Table) -> pa.Table:
    once = np.zeros(SEGMENT_CELLS // 8, np.uint8)
    twice = np.zeros(SEGMENT_CELLS // 8, np.uint8)
    for o, t in zip(table.column("once"), table.column("twice"), strict=True):
        other = np.frombuffer(zlib.decompress(o.as_py()), np.uint8)
        twice |= np.frombuffer(zlib.decompress(t.as_py()), np.uint8) | (once & other)
        once |= other
    return pa.table(
        {
            "segment": table.column("segment").slice(0, 1),
            "part": pa.array([table.column("part")[0].as_py() // FAN_IN], pa.int32()),
            "once": pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()),
            "twice": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary()),
        }
    )


def build(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The filters (packed bits) of hashes seen once or more and twice or more.

    ``hashes_of`` gives the unsigned 64-bit hashes of a batch; a hash that should count once for a row
    must be given once for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, waiting, size = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            waiting.append(cells_of(hashes_of(batch), cells).ravel().astype(np.int64))
            size += len(waiting[-1])
            if size > 4_000_000:
                yield from _parts(np.concatenate(waiting), part)
                waiting, size = [], 0
        if size:
            yield from _parts(np.concatenate(waiting), part)

    found = rows.mapInArrow(run, _SCHEMA)
    parts = rows.rdd.getNumPartitions()
    while parts > FAN_IN:
        found = found.groupBy("segment", F.expr(f"part div {FAN_IN}")).applyInArrow(_merge, _SCHEMA)
        parts = -(-parts // FAN_IN)
    merged = found.groupBy("segment").applyInArrow(_merge, _SCHEMA)
    once = np.zeros(cells // 8, np.uint8)
    twice = np.zeros(cells // 8, np.uint8)
    size = SEGMENT_CELLS // 8
    for row in merged.collect():
        once[row.segment * size : (row.segment + 1) * size] = np.frombuffer(zlib.decompress(row.once), np.uint8)
        twice[row.segment * size : (row.segment + 1) * size] = np.frombuffer(zlib.decompress(row.twice), np.uint8)
    return once, twice

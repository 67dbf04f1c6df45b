"""Batches of texts as ragged numpy arrays, and the Arrow plumbing the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes handled by one run of the vectorised code; longer texts are taken alone.
SLICE = 1 << 20

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: A random 64-bit value for every byte, from the splitmix rule.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


BYTE_VALUE = mix((np.arange(256, dtype=U64) + U64(1)) * _BASE)
LOWER_VALUE = BYTE_VALUE[LOWER]
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE)
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, joined, and the n + 1 offsets of its rows; null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the byte values in the given closed ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Every byte but space and the ASCII controls that count as white space.
NOT_SPACE = ~table((0x20, 0x20), (0x09, 0x0D))


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a set within each row: starts, ends, and runs per row."""
    mask = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], mask[:-1])) & ~edge[:-1] if len(data) else mask
    after = np.concatenate((mask[1:], [False])) & ~edge[1:] if len(data) else mask
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """A 64-bit hash of each span, from polynomial prefix sums; spans are sorted and disjoint."""
    out = np.zeros(len(starts), U64)
    at = 0
    while at < len(starts):
        end = max(int(np.searchsorted(ends, starts[at] + SLICE, "right")), at + 1)
        low, high = int(starts[at]), int(ends[end - 1])
        up, down = powers(high - low + 1)
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(values[data[low:high]] * up[:-1], out=sums[1:])
        s, e = starts[at:end] - low, ends[at:end] - low
        out[at:end] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        at = end
    return out


def row_of(counts: np.ndarray) -> np.ndarray:
    """The row number of each element of a ragged array."""
    return np.repeat(np.arange(len(counts)), counts)


def starts_of(counts: np.ndarray) -> np.ndarray:
    """n + 1 offsets of a ragged array."""
    return np.concatenate(([0], np.cumsum(counts)))


def release() -> None:
    """Give memory that a finished task no longer uses back to the system; idle workers live on beside later ones."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def per_task(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function over the batches of a task, releasing memory at its end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return whole


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, rows: int | None = None) -> DataFrame:
    """Apply ``make()(batch)`` to the Arrow batches of every partition, cut to ``rows`` rows each if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = None
        for batch in batches:
            handle = handle or make()
            step = rows or max(batch.num_rows, 1)
            for at in range(0, batch.num_rows, step):
                yield handle(batch.slice(at, step))
        del handle

    return df.mapInArrow(per_task(run), schema)

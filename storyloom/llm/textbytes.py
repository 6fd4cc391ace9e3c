"""Arrow text columns as byte arrays: words, and 64-bit hashes of words and byte ranges.

Everything works on a whole chunk of texts at once, so the cost per text is that of its
bytes. A chunk is a slice of an Arrow batch with at most ``CHUNK`` bytes of text, or one
longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``size`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one entry more
    than texts). A null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    flat = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, at - at[0]


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            made = np.full(n, base, np.uint64)
            made[0] = 1
            _powers[name] = np.multiply.accumulate(made)
    return _powers["up"][:n], _powers["down"][:n]


class Ranges:
    """Polynomial hashes of ranges of a sequence of 64-bit numbers."""

    def __init__(self, values: np.ndarray):
        up, self.down = _up_to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + mix(length + np.uint64(seed)))


def byte_ranges(data: np.ndarray) -> Ranges:
    return Ranges(_BYTE[data])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of bytes other than ASCII white
    space (0x20, 0x09 to 0x0D)."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Arrow longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))

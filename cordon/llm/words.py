"""Words of a batch of texts as numpy arrays.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D), which is what
``[^\\x20\\x09-\\x0D]+`` finds in the decoded text, as no byte of a multi-byte character lies in
that range. All work is done on the UTF-8 buffer of the Arrow column; no Python string is made.
Texts are taken in slices of about a megabyte, so memory depends on the slice (or on the largest
single text) and not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1024
HASH_CHUNK = 1 << 18

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, HASH_CHUNK + 4096)
        for key, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (sorted, not overlapping), from prefix sums of a polynomial."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, lo + HASH_CHUNK)))
        hi = int(ends[j - 1])
        up, down = _power_tables(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


@dataclass
class Texts:
    """A slice of texts: UTF-8 bytes, text offsets into them, and the words found."""

    first: int  # row of the batch that the slice begins with
    data: np.ndarray
    offsets: np.ndarray  # len(texts) + 1
    starts: np.ndarray
    ends: np.ndarray
    text_of: np.ndarray  # row in the slice of each word

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def word_offsets(self) -> np.ndarray:
        """Where each text's words begin in the word arrays; len(texts) + 1."""
        return np.searchsorted(self.text_of, np.arange(self.n + 1))

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)


def _find(first: int, data: np.ndarray, offsets: np.ndarray) -> Texts:
    solid = ~IS_SPACE[data]
    size = len(data)
    if size == 0:
        none = np.zeros(0, np.int64)
        return Texts(first, data, offsets, none, none, none)
    edge = np.zeros(size + 1, dtype=bool)  # where a text begins or ends
    edge[offsets] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:size]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:size]
    starts = np.flatnonzero(begin)
    return Texts(first, data, offsets, starts, np.flatnonzero(end) + 1,
                 np.searchsorted(offsets[1:], starts, side="right"))


def slices(column: pa.Array) -> Iterator[Texts]:
    """Slices of a string column; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for first in range(0, len(column), SLICE_ROWS):
        yield from _slices(first, column.slice(first, SLICE_ROWS))
    pa.default_memory_pool().release_unused()  # else each worker keeps the pages of its largest batch


def _slices(first: int, column: pa.Array) -> Iterator[Texts]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, side="right")) - 1)
        j = min(j, n)
        lo, hi = int(offsets[i]), int(offsets[j])
        yield _find(first + i, data[lo:hi], offsets[i:j + 1] - lo)
        i = j

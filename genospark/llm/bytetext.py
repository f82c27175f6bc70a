"""Vectorised helpers over the bytes of a batch of texts: words, word hashes, shingle hashes.

They run inside tasks on slices of an Arrow batch; memory follows the slice, not the partition.
Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

R = np.uint64(0x9E3779B97F4A7C15 | 1)
R_INVERSE = np.uint64(pow(int(R), -1, 2**64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SLICE_BYTES = 1 << 18
SLICE_ROWS = 512

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((R, R_INVERSE)):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads a polynomial hash over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts. first[d]:first[d+1] are the words of text d; start and end are byte positions in data."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        p, inverse = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=total[1:])
        return total, inverse

    def hashes(self, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
        """The words' hashes, then those of their first n bytes for each n (0 where a word has no more than n bytes)."""
        total, inverse = self.sums()
        out = [mix((total[self.end] - total[self.start]) * inverse[self.start])]
        for n in prefixes:
            stop = np.minimum(self.start + n, self.end)
            h = mix((total[stop] - total[self.start]) * inverse[self.start] + np.uint64(n))
            h[self.end - self.start <= n] = 0
            out.append(h)
        return out

    def bare(self) -> "Words":
        """The words without ASCII punctuation at either end, however much; of a word of nothing else its middle character stays."""
        solid = np.flatnonzero(~PUNCTUATION[self.data])
        at, to = np.searchsorted(solid, self.start), np.searchsorted(solid, self.end)
        some, middle = at < to, self.start + (self.end - self.start - 1) // 2
        start, end = middle.copy(), middle + 1
        start[some], end[some] = solid[at[some]], solid[to[some] - 1] + 1
        return Words(self.data, self.bounds, start, end, self.first)

    def texts(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, bounds: np.ndarray) -> Words:
    """data: bytes of texts that lie one behind the other; text d is data[bounds[d]:bounds[d+1]]."""
    data = LOWER[data]
    solid = ~SPACE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, bounds, none, none, np.zeros(len(bounds), np.int64))
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    opens[inner] = solid[inner]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    closes[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, bounds, start, end, np.searchsorted(start, bounds))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of rows of about `most` bytes; a longer text is a run of its own. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary()) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, stop, data[offsets[at] : offsets[stop]], (offsets[at : stop + 1] - offsets[at]).astype(np.int64)
        at = stop


def parts(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in runs of a few rows, so that what a task holds of them at once stays small.

    Workers outlive their tasks: at the end freed memory goes back to the system.
    """
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    b = None
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def shingle_hashes(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): hashes of the word shingles of each text; a text with fewer words has its whole sequence as one."""
    h = w.hashes()[0]
    count = np.diff(w.first)
    n = len(h)
    seeds = mix(np.arange(1, size + 1, dtype=np.uint64))
    m = max(n - size + 1, 0)
    full = np.zeros(m, np.uint64)
    for k in range(size):
        full += mix(h[k : k + m] ^ seeds[k]) * (seeds[k] | np.uint64(1))
    made = np.maximum(count - size + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(bounds[-1], np.uint64)
    long = np.flatnonzero(count >= size)
    if len(long):
        k = made[long]
        inner = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        out[np.repeat(bounds[long], k) + inner] = full[np.repeat(w.first[long], k) + inner]
    for d in np.flatnonzero((count > 0) & (count < size)):
        x = np.full(1, count[d], np.uint64)
        for k in range(count[d]):
            x = mix(x * R + h[w.first[d] + k])
        out[bounds[d]] = x[0]
    return mix(out), bounds

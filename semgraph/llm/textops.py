"""Vectorised text primitives over Arrow string columns.

Everything here works on the flat UTF-8 bytes of a batch, so no Python object
is made per word.  A *word* is a maximal run of bytes outside 0x20 and
0x09-0x0D, which on UTF-8 equals the regular expression ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(32)
_SHIFT2 = np.uint64(29)
#: Words of more bytes than this are hashed one by one.
_LONG_WORD = 256
_MASKS = np.array([(1 << (8 * k)) - 1 if k < 8 else 2**64 - 1 for k in range(9)], dtype=np.uint64)

#: Bytes of text that one vectorised step takes together; a longer text goes alone.
STEP_BYTES = 2 << 20


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that gives free memory back at the end of a task: Spark keeps the worker for later ones, of whatever kind."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)

    return task


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x * _MUL
    x ^= x >> _SHIFT
    x *= _MUL2
    x ^= x >> _SHIFT2
    return x


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one array without nulls; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each begins (one more: the end)."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def steps(column: pa.Array, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one longer text."""
    limit = limit or STEP_BYTES
    _, offsets = flat(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(rows, max(row + 1, end))
        yield row, end
        row = end


class Words:
    """The words of a batch of texts: first byte, end, and the row of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        word = ~_SPACE[data]
        first, last = word.copy(), word.copy()
        if n:
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            own = offsets[:-1][offsets[1:] > offsets[:-1]]
            first[own] = word[own]
            ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
            last[ends] = word[ends]
        self.is_word = word
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        #: The words of row r are bounds[r] to bounds[r + 1].
        self.bounds = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.bounds)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """64 bits of each word; words of up to eight bytes and one length never collide."""
        return hash_spans(self.data, self.start, self.end)

    def text(self, index: int) -> bytes:
        return self.data[self.start[index] : self.end[index]].tobytes()


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time."""
    length = end - start
    out = length.astype(np.uint64) * _MUL2
    if not len(start):
        return out
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    active = np.flatnonzero(length <= _LONG_WORD)
    done = 0
    while len(active):
        left = np.minimum(length[active] - done, 8)
        out[active] = mix(out[active] ^ (eight[start[active] + done] & _MASKS[left]))
        done += 8
        active = active[length[active] > done]
    raw = data.data if data.flags.c_contiguous else np.ascontiguousarray(data).data
    for i in np.flatnonzero(length > _LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(raw[start[i] : end[i]])
    return out


def windows(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words that lie in one row, and the first word of each."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(hashes) - n + 1
    inside = np.ones(last, dtype=bool)
    for edge in bounds[1:-1]:
        inside[max(0, edge - n + 1) : edge] = False
    at = np.flatnonzero(inside)
    return run_hash(hashes, at, n), at


def run_hash(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each position in ``at``."""
    out = hashes[at]
    for j in range(1, n):
        out = mix(out * _MUL2 + hashes[at + j])
    return out


class Rolling:
    """Hashes of runs of any number of words, each in one step: differences of prefix sums of a polynomial modulo 2**64."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        factors, inverse = np.full(n, _MUL2), np.full(n, np.uint64(pow(int(_MUL2), -1, 2**64)))
        factors[0] = inverse[0] = 1
        self.power = np.multiply.accumulate(factors)
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(hashes * np.multiply.accumulate(inverse)[:-1], out=self.sums[1:])

    def windows(self, at: np.ndarray, n: int) -> np.ndarray:
        """The hash of the n words from each position in ``at``."""
        return mix((self.sums[at + n] - self.sums[at]) * self.power[at])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    if len(keys) < 2:
        return np.zeros(len(keys), dtype=bool)
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]]
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[place] == keys


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive offsets; empty ranges give 0."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def hash_lines(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of long byte ranges."""
    raw = memoryview(np.ascontiguousarray(data))
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(raw[s:e]) for s, e in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(start))

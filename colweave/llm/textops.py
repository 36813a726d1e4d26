"""Words, spans and hashes of whole Arrow text columns with numpy, no loop per row.

A column is taken as one byte array plus row offsets; null counts as empty text. Words, lines and other
spans that are to be told apart get numbers by their bytes (`numbered`) or keys by xxh3 (`keys`).
Karp-Rabin prefix sums (`span_hashes`, modulo 2**64) serve for spans of bounded length and as a first
look before bytes are compared: for long spans of two alternating contents this modulus has equal hashes
for different spans. Callers work on row groups of a few MB (`groups`), so memory follows the group, or
the longest single text, and not the partition.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that one numpy step handles at a time.
GROUP_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and the row offsets (one more than rows); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(batch: pa.RecordBatch, column: str = "text", most: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about `most` bytes; a longer text is a slice of its own."""
    ends = texts(batch.column(column))[1][1:]
    at = 0
    while at < batch.num_rows:
        begun = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begun + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 to base**(n - 1), modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, GROUP_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= GROUP_BYTES + 1:  # a worker keeps no more than that between groups
            _powers[base] = have
    return have[:n]


def release() -> None:
    """Gives memory that a worker holds, but does not use, back at the end of a task: the powers, Arrow's, and
    what the C library keeps of freed arrays, where it can be asked to."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Karp-Rabin prefix sums, one more than codes, for `span_hashes`."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end); equal contents of equal length hash alike."""
    back = powers(len(sums), BASE_INVERSE)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; no run goes over a row's end."""
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words `[^\\x20\\x09-\\x0D]+`."""
    return runs(~IS_SPACE[data], offsets)


def cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The spans [start, end) as values of an Arrow array."""
    size = ends - starts
    to = np.concatenate([[0], np.cumsum(size)])
    if len(size) and np.array_equal(starts[1:], ends[:-1]):  # side by side: no array with a number for each byte
        inside = np.ascontiguousarray(data[starts[0] : ends[-1]])
    else:
        inside = data[np.repeat(starts - to[:-1], size) + np.arange(to[-1])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(inside)])


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each span [start, end): equal for equal bytes and different for others."""
    if not len(starts):
        return np.zeros(0, np.int64)
    return cut_out(data, starts, ends).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key for each span [start, end), from its bytes alone, the same in every group."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    found = cut_out(data, starts, ends).dictionary_encode()
    distinct = np.array([xxhash.xxh3_64_intdigest(v) for v in found.dictionary.to_pylist()], np.uint64)
    return distinct[found.indices.to_numpy(zero_copy_only=False)]


def per_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each row's spans begin among all spans; one more than rows."""
    return np.searchsorted(starts, offsets, "left")


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each span, from `per_row`'s bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sums_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    total = np.zeros(len(values) + 1, kind)
    np.cumsum(values, out=total[1:], dtype=kind)
    return total[bounds[1:]] - total[bounds[:-1]]


class HashIndex:
    """Numbers distinct 64-bit keys 0, 1, 2 ... by open addressing on whole arrays."""

    def __init__(self, bits: int = 16):
        self.size = 0
        self._make(bits)

    def _make(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.numbers = np.full(1 << bits, -1, np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for unknown ones."""
        slot = keys & self.mask
        out = self.numbers[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[open_]
        while len(open_):
            slot = (slot + np.uint64(1)) & self.mask
            got = self.numbers[slot]
            out[open_] = got
            on = (got >= 0) & (self.keys[slot] != keys[open_])
            open_, slot = open_[on], slot[on]
        return out

    def add(self, keys: np.ndarray) -> None:
        """New distinct keys get the next numbers, in their order."""
        if (self.size + len(keys)) * 2 > len(self.keys):
            used = self.numbers >= 0
            old, numbers = self.keys[used], self.numbers[used]
            self._make(int(4 * (self.size + len(keys))).bit_length())
            self._put(old, numbers)
        self._put(keys, np.arange(self.size, self.size + len(keys)))
        self.size += len(keys)

    def _put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        slot = keys & self.mask
        while len(keys):
            free = self.numbers[slot] < 0
            self.keys[slot[free]], self.numbers[slot[free]] = keys[free], numbers[free]
            left = self.numbers[slot] != numbers
            keys, numbers, slot = keys[left], numbers[left], (slot[left] + np.uint64(1)) & self.mask

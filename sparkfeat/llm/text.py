"""Vectorised text scanning inside a task: words, lines and rolling hashes of
whole texts, over Arrow string columns, a few megabytes at a time.

A text is the UTF-8 bytes of its value; null counts as empty.  Hashes are
64-bit polynomials over randomised symbol values, finished with a bit mixer.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: Separators of the plain word rule: space and the control characters 9-13.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Separators of the alphanumeric rule (after lower-casing A-Z): all ASCII but digits and a-z.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:0x80] = True
NOT_ALNUM[0x30:0x3A] = False
NOT_ALNUM[0x61:0x7B] = False
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` for ``i <= n`` (modulo 2**64), kept and grown."""
    global _pow, _inv
    if len(_pow) <= n:
        size = max(n + 1, CHUNK_BYTES + (CHUNK_BYTES >> 1))
        grow = [np.full(size, b, np.uint64) for b in (_BASE, _BASE_INV)]
        for g in grow:
            g[0] = 1
        _pow, _inv = (np.multiply.accumulate(g) for g in grow)
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any span ``[start, end)`` of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray):
        power, self.inverse = _powers(len(symbols))
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * power[:len(symbols)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, n: int) -> np.ndarray:
        """Hash of every ``n`` consecutive symbols."""
        if len(self.sums) <= n:
            return np.zeros(0, np.uint64)
        return mix((self.sums[n:] - self.sums[:-n]) * self.inverse[:len(self.sums) - n])


class Texts:
    """A run of whole texts: bytes, and where each text starts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def part(self, at: int, to: int) -> "Texts":
        """Texts ``[at, to)`` of the run."""
        own = self.offsets[at:min(to, len(self)) + 1]
        return Texts(self.data[own[0]:own[-1]], own - own[0], self.first + at)

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every maximal run of True bytes that stays in one text."""
        n = len(member)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = member[:-1]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        before[edges] = False
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = member[1:]
        after[edges - 1] = False
        return np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1

    def words(self, data: np.ndarray, separators: np.ndarray) -> "Words":
        starts, ends = self.runs(~separators[data])
        return Words(data, starts, ends, np.searchsorted(starts, self.offsets))


class Words:
    """Words of a run of texts; words ``first[d]:first[d + 1]`` belong to text ``d``."""

    def __init__(self, data, starts, ends, first):
        self.data, self.starts, self.ends, self.first = data, starts, ends, first
        self.counts = np.diff(first)

    def __len__(self) -> int:
        return len(self.starts)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        spans = Rolling(BYTE_VALUE[self.data]).spans(self.starts, self.ends)
        return mix(spans + (self.ends - self.starts).astype(np.uint64))

    def windows(self, n: int) -> np.ndarray:
        """Index of the first word of every window of ``n`` words of one text."""
        per = np.maximum(self.counts - (n - 1), 0)
        total = int(per.sum())
        if not total:
            return np.zeros(0, np.int64)
        begin = np.cumsum(per) - per
        return np.arange(total) + np.repeat(self.first[:-1] - begin, per)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space after each, and each word's start and end there."""
        length = self.ends - self.starts
        start = np.cumsum(length + 1) - (length + 1)
        out = np.full(int((length + 1).sum()), 32, np.uint8)
        index = np.repeat(self.starts - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        out[np.repeat(np.arange(len(length)), length) + np.arange(len(index))] = self.data[index]
        return out, start, start + length


def covered(n: int, starts: np.ndarray, length) -> np.ndarray:
    """Which of ``n`` places lie in ``[s, s + length)`` of any start."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + length, -1)
    return np.cumsum(delta[:-1]) > 0


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over the elements of each text."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]


def chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES):
    """``Texts`` of whole values, about ``chunk_bytes`` at a time (a longer text
    is a chunk of its own)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield Texts(data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at], at)
        at = end


def release() -> None:
    """Give freed memory back to the system: workers are reused, and two large
    steps need not add up in one worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)

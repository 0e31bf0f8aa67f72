"""Whole texts as flat byte arrays: words, lines and shingles of many documents at once with numpy.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; UTF-8 never uses those bytes inside a longer character,
so byte positions and characters agree.  Hashes are 64-bit and equal in every process."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18  # numpy holds some hundred bytes a text byte while a chunk is worked on
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_SHINGLE_MUL = _rng.integers(1, 2**63, 64, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)
_powers = {_BASE: np.ones(1, np.uint64), _BASE_INV: np.ones(1, np.uint64)}
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers[base]
    while len(have) < n:
        have = np.concatenate([have, have * _U(pow(base, len(have), 2**64))])
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Chunk:
    """Consecutive texts of a batch; ``bounds[i]:bounds[i + 1]`` are the bytes of text ``first + i``."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.data, self.bounds = first, data, bounds
        self.n = len(bounds) - 1
        space = IS_SPACE[data]
        begins = ~space
        begins[1:] &= space[:-1] | False
        inner = bounds[:-1][bounds[:-1] < len(data)]
        begins[inner] = ~space[inner]
        ends = ~space
        ends[:-1] &= space[1:]
        last = bounds[1:] - 1
        last = last[(last >= 0) & (bounds[1:] > bounds[:-1])]
        ends[last] = ~space[last]
        self.space = space
        self.word_start = np.flatnonzero(begins)
        self.word_end = np.flatnonzero(ends) + 1
        self.word_bounds = np.searchsorted(self.word_start, bounds)
        self.n_words = np.diff(self.word_bounds)
        self._sums = None

    def span_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[self.data] * _power(_BASE, len(self.data)), out=self._sums[1:])
        shift = _power(_BASE_INV, len(self.data) + 1)
        return mix((self._sums[end] - self._sums[start]) * shift[start] + (end - start).astype(np.uint64))

    def word_hashes(self) -> np.ndarray:
        return self.span_hashes(self.word_start, self.word_end)

    def shingles(self, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every k-word window in order, and the bounds per text.  A text of 1 .. k - 1 words has one window,
        its whole sequence; a text without words has none."""
        words = self.word_hashes()
        counts = np.where(self.n_words >= k, self.n_words - k + 1, np.minimum(self.n_words, 1))
        out_bounds = np.zeros(self.n + 1, np.int64)
        np.cumsum(counts, out=out_bounds[1:])
        at = np.repeat(self.word_bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
        total = np.zeros(len(at), np.uint64)
        padded = np.concatenate([words, np.zeros(k, np.uint64)])
        for j in range(k):
            total += padded[at + j] * _SHINGLE_MUL[j]
        for i in np.flatnonzero((self.n_words > 0) & (self.n_words < k)):
            own = words[self.word_bounds[i]:self.word_bounds[i + 1]]
            total[out_bounds[i]] = (own * _SHINGLE_MUL[:len(own)]).sum(dtype=np.uint64) + _U(len(own))
        return mix(total), out_bounds


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into runs of about ``limit`` bytes (a longer text is a run of its own); null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(flat) == 0:
        return
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    raw = flat.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(flat):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield Chunk(lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def pack40(values: np.ndarray) -> bytes:
    """The low five bytes of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack40(raw: bytes) -> np.ndarray:
    low = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    out = np.zeros((len(low), 8), np.uint8)
    out[:, :5] = low
    return out.reshape(-1).view("<u8")

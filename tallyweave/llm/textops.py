"""Vectorised work on whole batches of texts, shared by the operators of this subpackage.

A batch is one byte buffer and the offsets of its texts. Hashes are polynomial
sums modulo 2**64 over prefix sums, so that the hash of any window costs two
look-ups whatever its length.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: The six bytes that separate words: space, and tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = [mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * k)) for k in range(2)]
_STEP = 1 << 16
_POWERS: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}


def _steps(base: int, inverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to _STEP - 1 of a base, or of its inverse, modulo 2**64, and those of its _STEP-th power."""
    if (base, inverse) not in _POWERS:
        b = pow(_BASES[base], -1, 1 << 64) if inverse else _BASES[base]
        tables = []
        for x in (b, pow(b, _STEP, 1 << 64)):
            table = np.full(_STEP, x, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _POWERS[base, inverse] = tuple(tables)
    return _POWERS[base, inverse]


def powers(n: int, base: int = 0, inverse: bool = False) -> np.ndarray:
    """The first n powers; only two small tables stay in memory."""
    low, high = _steps(base, inverse)
    return (high[: -(-n // _STEP), None] * low[None, :]).ravel()[:n] if n > _STEP else low[:n]


def powers_at(places: np.ndarray, base: int = 0, inverse: bool = False) -> np.ndarray:
    low, high = _steps(base, inverse)
    return high[places >> 16] * low[places & (_STEP - 1)]


class Sums:
    """Prefix sums over codes; the hash of codes[s:e] is the same wherever the run stands."""

    def __init__(self, codes: np.ndarray, base: int = 0):
        n = len(codes)
        self.base = base
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * powers(n, base), out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(self.sums)
        inv = powers(n, self.base, True)[start] if 4 * len(start) > n else powers_at(start, self.base, True)
        return mix((self.sums[end] - self.sums[start]) * inv)


def byte_sums(buf: np.ndarray, base: int = 0) -> Sums:
    return Sums(_BYTE_CODES[base][buf], base)


def batch(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts as one buffer, and len(texts) + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    kind = texts.type
    if not (pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(kind) else pa.large_string())
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_large_binary(texts.type) else "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about so many bytes, which bounds what a task holds at a time."""
    step = max(1, min(batch.num_rows, int(batch.num_rows * most / max(1, batch.nbytes))))
    for s in range(0, batch.num_rows, step):
        yield batch.slice(s, step)


def light(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work on batches, after which the worker gives unused memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Free memory that this worker holds but doesn't use, so that a reused worker is as small as a new one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of non-separators, and the first word of each text."""
    edges = np.zeros(len(buf) + 1, bool)
    edges[offs] = True
    solid = ~SPACES[buf]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edges[:-1]))
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edges[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all else as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[buf]


def word_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """A 64-bit code of each word; its length is part of it."""
    return mix(byte_sums(buf, base).hash(starts, ends) + (ends - starts).astype(np.uint64))


def strings(buf: np.ndarray, lengths: np.ndarray, text: bool) -> pa.Array:
    """Consecutive pieces of buf as an Arrow array."""
    offs = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offs[1:])
    kind = pa.large_string() if text else pa.large_binary()
    return pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(buf))]).cast(pa.string() if text else pa.binary())


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """For each of n places, whether one of the ranges covers it."""
    d = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(d[:n]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true."""
    d = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)

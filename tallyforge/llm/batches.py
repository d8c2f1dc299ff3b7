"""Arrow text columns as numpy bytes, in chunks of bounded size (or one document, if that is longer)."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 17
#: Task memory that is freed goes back to the system at once.
pa.set_memory_pool(pa.system_memory_pool())
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Gives memory that was freed in pieces back to the system, where the C library can."""
    if _trim:
        _trim(0)


SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): text i is bytes[offsets[i]:offsets[i + 1]]; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)), at - at[0]


def chunks(data: np.ndarray, offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) for runs of whole texts of at most ``most`` bytes, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def segment_max(values: np.ndarray, offsets: np.ndarray, empty: float) -> np.ndarray:
    """The largest of values[offsets[i]:offsets[i + 1]], ``empty`` for an empty stretch."""
    out = np.full(len(offsets) - 1, empty)
    some = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(some):
        out[some] = np.maximum.reduceat(values, offsets[some])
    return out


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64))


class SpanHash:
    """Hashes of any stretches of a byte array in constant time each (a polynomial modulo 2**64, mixed)."""

    def __init__(self, data: np.ndarray):
        self.inverse = powers(len(data), BASE_INVERSE)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUE[data] * powers(len(data), BASE)[: len(data)], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): runs of bytes that aren't ``apart`` (by default [^\\x20\\x09-\\x0D]+) as byte ranges; text i has words first[i]:first[i + 1]."""
    space = apart[data]
    begins = ~space
    begins[1:] &= space[:-1]
    ends = ~space
    ends[:-1] &= space[1:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def gram_hash(h: np.ndarray, n: int, base: int = BASE) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes (of one batch; runs may cross texts)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    p = powers(n, base)
    out = h[: len(h) - n + 1] * p[0]
    for j in range(1, n):
        out = out + h[j : len(h) - n + 1 + j] * p[j]
    return mixed(out)


def argmin_windows(h: np.ndarray, w: int) -> np.ndarray:
    """For every window of w values, the place of its leftmost least value (of 63 bits or fewer)."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(len(h))
    span = 1
    while span < w:
        step = min(span, w - span)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(h[b] < h[a], b, a)
        span += step
    return best


def ranges(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value): for each row i the values start[i] .. start[i] + length[i] - 1."""
    row = np.repeat(np.arange(len(start)), length)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length) + start[row]

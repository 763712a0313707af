"""Words of Arrow text batches as numpy arrays (shared by operators 2, 6 and 8).

A word is a run of ASCII digits, ASCII letters (A-Z lower-cased) and non-ASCII
characters; on UTF-8 that is a run of bytes, so whole batches are cut with a
few array operations and no per-word Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: bytes of text cut at once; bounds the arrays a task holds (about 40 x this)
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[0x00:0x30] = IS_WORD[0x3A:0x61] = IS_WORD[0x7B:0x80] = False

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Words:
    """Words of some texts: ``low`` are the lower-cased bytes, a word i is
    ``low[start[i]:end[i]]`` in text ``doc[i]``; ``hash`` are 64-bit hashes."""

    low: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def text(self, i: int) -> bytes:
        return self.low[self.start[i]: self.end[i]].tobytes()


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """The first n powers of ``base`` mod 2^64; the longest table is kept."""
    p = _POWERS.get(base)
    if p is None or len(p) < n:
        p = np.full(max(1 << 16, n), base, np.uint64)
        p[0] = 1
        _POWERS[base] = p = np.multiply.accumulate(p)
    return p[:n]


def release() -> None:
    """Hands freed memory back to the system: Python workers stay for later
    tasks, beside those that run then."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes mod 2^64 of many spans of one array at once."""
    n = len(values)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(n), out=c[1:])
    return mix((c[end] - c[start]) * powers(n, _INVERSE)[start])


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit``
    bytes; NULL is empty.  A longer text is a run of its own."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset: texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b, data[off[a]: off[b]], off[a: b + 1] - off[a]
        a = b
    release()


def cut_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    low = LOWER[data]
    n = len(low)
    inside = IS_WORD[low]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edge = offsets[1:-1][(offsets[1:-1] < n) & (offsets[1:-1] > 0)]
    start[edge] = inside[edge]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(low, offsets, start, end, doc, span_hashes(low, start, end) if n else np.zeros(0, np.uint64))

"""Vectorised text kernels shared by the Arrow-side operators.

Every function works on the UTF-8 bytes of a whole batch at once: a batch is
``(data, offsets)`` with ``data`` a uint8 array and ``offsets`` the document
bounds.  Nothing here knows about Spark.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once, so that temporaries stay in tens of MB.  A
#: longer document is handled alone.
CHUNK_BYTES = 1 << 20


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(members, dtype=np.uint8)] = True
    return table


#: [^\x20\x09-\x0D]
NON_SPACE = ~byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] in UTF-8: digits, a-z and all of non-ASCII
ALNUM_LOWER = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
#: bytes that begin a code point
CODE_POINT = ~byte_table(bytes(range(128, 192)))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240817)
_BYTE_CODE = _rng.integers(1, 2**64, 256, dtype=U64)
_P = U64(0x9E3779B97F4A7C15)
_PINV = U64(pow(int(_P), -1, 2**64))
_MIX = tuple(U64(x | 1) for x in _rng.integers(1, 2**64, 64, dtype=U64).tolist())


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    p, q = np.full(size, _P, dtype=U64), np.full(size, _PINV, dtype=U64)
    p[0] = q[0] = 1
    return np.cumprod(p, dtype=U64), np.cumprod(q, dtype=U64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse; a table of a power of two is kept."""
    n = 1 << max(21, int(size).bit_length())
    return _powers(n)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of murmur3 (64 bits)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(bounds, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about ``limit`` bytes: first, end, bytes, bounds."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes in ``table``, which no document's bound
    crosses; and for each document bound the number of words before it."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = table[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edge[:n]] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edge[1:]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings ``data[start:end]``."""
    n = len(data)
    p, q = powers(n + 1)
    sums = np.empty(n + 1, dtype=U64)
    sums[0] = 0
    np.cumsum(_BYTE_CODE[data] * p[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(U64))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k hashes from each place on (the last k - 1 places have none)."""
    if len(h) < k:
        return np.zeros(0, U64)
    m = len(h) - k + 1
    out = h[:m] * _MIX[0]
    for i in range(1, k):
        out += h[i : i + m] * _MIX[i]
    return mix(out + U64(k))


def window_starts(word_bounds: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which places of ``window_hashes`` begin a window that stays in its document."""
    m = total - k + 1
    if m <= 0:
        return np.zeros(0, bool)
    ok = np.ones(m, dtype=bool)
    for i in range(1, k):  # a window must not hold a later document's first word
        inner = word_bounds[1:-1] - i
        ok[inner[(inner >= 0) & (inner < m)]] = False
    return ok


def per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a 0/1 or numeric array over document bounds."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]

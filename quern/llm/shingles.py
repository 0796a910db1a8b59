"""Sets of word shingles, and their signatures of universal hash minima."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quern.llm import kernels as K


class Signer:
    """``bands * rows`` multiply-shift hash functions; each gives the minimum over a set.

    Values are 32 bits wide while candidates are looked for; links are later
    confirmed on whole sets of 64-bit shingle hashes.
    """

    def __init__(self, bands: int, rows: int, seed: int):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = (rng.integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1))[:, None]
        self.b = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)[:, None]
        self.band_mix = rng.integers(0, 2**64, (1, rows), dtype=np.uint64) | np.uint64(1)
        self.band_salt = K.mix(rng.integers(0, 2**64, bands, dtype=np.uint64))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> K.U64(32)).astype(np.uint32)
        out = None
        for i in range(0, len(x), 2048):
            block = (self.a * x[None, i : i + 2048] + self.b).min(axis=1)
            out = block if out is None else np.minimum(out, block)
        return out

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band (the band's number is mixed in); rows: documents."""
        grid = minima.astype(np.uint64).reshape(len(minima), self.bands, self.rows)
        keys = (K.mix(grid + K.U64(0x51ED27)) * self.band_mix).sum(axis=2, dtype=np.uint64)
        return K.mix(keys ^ self.band_salt[None, :])


def shingle_sets(column: pa.Array, size: int):
    """For each text its distinct shingle hashes, sorted; empty without words.

    A text of fewer than ``size`` words has one shingle, its whole sequence.
    """
    data, offsets = K.utf8(column)
    for i, j, raw, bounds in K.chunks(data, offsets):
        low = K.LOWER[raw]
        starts, ends, first = K.words(low, bounds, K.NON_SPACE)
        h = K.span_hashes(low, starts, ends)
        windows = K.window_hashes(h, size)
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= size:
                yield np.unique(windows[a : b - size + 1])
            elif b > a:
                yield K.window_hashes(h[a:b], b - a)
            else:
                yield h[:0]


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    a, b = K.mix(s ^ K.U64(0xA5A5)).sum(dtype=np.uint64), K.mix(s * K.U64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(np.int64(a)), int(np.int64(b))


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b| on whole sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) == 0 or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)

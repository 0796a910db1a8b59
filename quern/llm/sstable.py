"""A sorted string table of token ids: the file format of operator 9.

    header   magic, width of an id (2 or 4 bytes)
    blocks   zstd-compressed; entries (shared, unshared, key suffix, length, ids)
             with keys prefix-compressed against the entry before
    index    for each block: first key, place, length, documents, ids before it
    Bloom    bit array over all keys
    footer   places of index and filter, counts, CRC-32 of index and filter, magic

Keys are 9 bytes that sort as the identifiers do: a null first, then the signed
64-bit integers.  A key may occur more than once.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import xxhash
import zstandard

MAGIC = b"QSST0001"
_HEADER = struct.Struct("<8sB7x")
_FOOTER = struct.Struct("<QQQQQQQII8s")  # index at, size; filter at, size; blocks, documents, ids; hashes, crc; magic
BLOCK_BYTES = 1 << 18
BITS_PER_KEY, HASHES = 10, 7


def key_of(doc_id: int | None) -> bytes:
    return b"\0" * 9 if doc_id is None else b"\1" + struct.pack(">Q", (doc_id + 2**63) & (2**64 - 1))


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:])[0] - 2**63


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bits(key: bytes, size: int) -> list[int]:
    a, b = xxhash.xxh64_intdigest(key, 1), xxhash.xxh64_intdigest(key, 2) | 1
    return [(a + i * b) % 2**64 % size for i in range(HASHES)]


class Writer:
    """Writes entries that come in the order of their keys; memory: one block, the index and 9 bytes a key."""

    def __init__(self, file: BinaryIO, width: int):
        self.file, self.width = file, width
        self.at = file.write(_HEADER.pack(MAGIC, width))
        self.block, self.entries, self.first, self.last = bytearray(), 0, b"", b""
        self.index: list[tuple[bytes, int, int, int, int]] = []
        self.keys: list[bytes] = []
        self.ids = self.block_ids = 0
        self.pack = zstandard.ZstdCompressor(level=1)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: the document's ids, little-endian, ``width`` bytes each."""
        key = key_of(doc_id)
        if self.keys and key < self.keys[-1]:
            raise ValueError("keys must not descend")
        shared = 0
        if self.entries:
            while shared < 9 and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.first, self.block_ids = key, self.ids
        self.block += _varint(shared) + _varint(9 - shared) + key[shared:] + _varint(len(ids)) + ids
        self.entries += 1
        self.last = key
        self.keys.append(key)
        self.ids += len(ids) // self.width
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.entries:
            data = self.pack.compress(bytes(self.block))
            self.index.append((self.first, self.at, len(data), self.entries, self.block_ids))
            self.at += self.file.write(data)
            self.block, self.entries = bytearray(), 0

    def close(self) -> None:
        self._flush()
        index = b"".join(k + struct.pack("<QQQQ", *rest) for k, *rest in self.index)
        size = max(64, -(-len(self.keys) * BITS_PER_KEY // 64) * 64)
        bits = np.zeros(size, np.uint8)
        for key in self.keys:
            bits[_bits(key, size)] = 1
        bloom = np.packbits(bits).tobytes()
        self.file.write(index + bloom)
        self.file.write(_FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), len(self.index), len(self.keys), self.ids, HASHES, zlib.crc32(index + bloom), MAGIC))


class Reader:
    """Reads a table: all entries in order, or one identifier by binary search."""

    def __init__(self, file: BinaryIO, size: int):
        self.file = file
        file.seek(size - _FOOTER.size)
        at, n, bloom_at, bloom_n, _, self.documents, self.ids, _, crc, magic = _FOOTER.unpack(file.read(_FOOTER.size))
        file.seek(0)
        start, self.width = _HEADER.unpack(file.read(_HEADER.size))
        if magic != MAGIC or start != MAGIC:
            raise ValueError("not a table of this format")
        file.seek(at)
        index, self.bloom = file.read(n), file.read(bloom_n)
        if zlib.crc32(index + self.bloom) != crc:
            raise ValueError("the index is damaged")
        self.index = [(index[i : i + 9], *struct.unpack_from("<QQQQ", index, i + 9)) for i in range(0, n, 41)]
        self.unpack = zstandard.ZstdDecompressor()

    def _block(self, i: int) -> Iterator[tuple[bytes, bytes]]:
        _, at, length, entries, _ = self.index[i]
        self.file.seek(at)
        data = self.unpack.decompress(self.file.read(length))
        at, key = 0, b""
        for _ in range(entries):
            shared, at = _read_varint(data, at)
            more, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + more]
            n, at = _read_varint(data, at + more)
            yield key, data[at : at + n]
            at += n

    def __iter__(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(identifier, ids before it in this file, its ids)."""
        for i, entry in enumerate(self.index):
            before = entry[4]
            for key, ids in self._block(i):
                yield id_of(key), before, ids
                before += len(ids) // self.width

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """The ids of the first entry of ``doc_id``, or None."""
        key = key_of(doc_id)
        size = len(self.bloom) * 8
        if not all(self.bloom[b >> 3] & (128 >> (b & 7)) for b in _bits(key, size)):
            return None
        i = max(0, bisect.bisect_left(self.index, key, key=lambda e: e[0]) - 1)
        while i < len(self.index) and self.index[i][0] <= key:
            for found, ids in self._block(i):
                if found == key:
                    return np.frombuffer(ids, f"<u{self.width}").astype(np.uint32)
            i += 1
        return None

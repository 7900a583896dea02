"""Token ids in bit-plane or byte-plane shards.

Shard: header, compressed planes block after block, document table, chunk index, footer.

    header    magic, planes per block, ids per block
    block     the ids' little-endian 32-bit forms transposed: all first bits (or bytes), all second
              ones, ...; each plane compressed by itself with zstandard
    documents validity byte, doc_id (int64) and number of ids (int64) of each document, compressed
    index     per block: place, number of ids and compressed length of each plane
    footer    places and lengths of the two tables, number of ids and documents, magic

A reader finds any range of ids by the chunk index and decodes only the blocks that hold it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import zstandard

MAGIC = b"OLPLANE1"
HEADER = struct.Struct("<8sII")
FOOTER = struct.Struct("<QQQQQQ8s")
BITS, BYTES = 32, 4


class PlaneWriter:
    """Writes one shard to an open binary stream; holds one block and 17 bytes per document."""

    def __init__(self, out, planes: int = BITS, block_ids: int = 65536, level: int = 3):
        if planes not in (BITS, BYTES) or block_ids % 8:
            raise ValueError("planes is 32 (bits) or 4 (bytes); a block has a multiple of 8 ids")
        self.out, self.planes, self.block_ids = out, planes, block_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.place = HEADER.size
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0
        self.index: list[tuple] = []
        self.valid, self.doc_ids, self.lengths = bytearray(), [], []
        self.n_ids = 0
        out.write(HEADER.pack(MAGIC, planes, block_ids))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.valid.append(doc_id is not None)
        self.doc_ids.append(doc_id or 0)
        self.lengths.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        if self.waiting_bytes >= 4 * self.block_ids:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        whole, size, first = b"".join(self.waiting), 4 * self.block_ids, 0
        while len(whole) - first >= size or last and first < len(whole):
            self._block(whole[first:first + size])
            first += size
        self.waiting = [whole[first:]]
        self.waiting_bytes = len(self.waiting[0])

    def _block(self, ids: bytes) -> None:
        packed = [self.zstd.compress(p) for p in split_planes(ids, self.planes)]
        self.index.append((self.place, len(ids) // 4, *map(len, packed)))
        for plane in packed:
            self.out.write(plane)
        self.place += sum(map(len, packed))

    def close(self) -> None:
        self._flush(last=True)
        table = self.zstd.compress(bytes(self.valid) + np.array(self.doc_ids, "<i8").tobytes()
                                   + np.array(self.lengths, "<i8").tobytes())
        index = self.zstd.compress(np.array(self.index, "<u8").tobytes())
        self.out.write(table)
        self.out.write(index)
        self.out.write(FOOTER.pack(self.place, len(table), self.place + len(table), len(index),
                                   self.n_ids, len(self.lengths), MAGIC))


class PlaneReader:
    """Reads one shard from a seekable binary file."""

    def __init__(self, file, size: int):
        self.file = file
        magic, self.planes, self.block_ids = HEADER.unpack(self._bytes(0, HEADER.size))
        table, table_n, index, index_n, self.n_ids, self.n_docs, again = FOOTER.unpack(
            self._bytes(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC or again != MAGIC:
            raise ValueError("not a plane shard")
        self.zstd = zstandard.ZstdDecompressor()
        self.index = np.frombuffer(self.zstd.decompress(self._bytes(index, index_n)), "<u8").reshape(
            -1, 2 + self.planes) if self.n_ids else np.zeros((0, 2 + self.planes), "<u8")
        rows = self.zstd.decompress(self._bytes(table, table_n))
        n = self.n_docs
        self.lengths = np.frombuffer(rows, "<i8", n, n + 8 * n)
        known = np.frombuffer(rows, "u1", n)
        self.doc_ids = [int(d) if k else None
                        for d, k in zip(np.frombuffer(rows, "<i8", n, n), known, strict=True)]

    def _bytes(self, place: int, n: int) -> bytes:
        self.file.seek(int(place))
        return self.file.read(int(n))

    def block(self, number: int) -> bytes:
        place, n, *sizes = (int(x) for x in self.index[number])
        packed, planes = self._bytes(place, sum(sizes)), []
        for size in sizes:
            planes.append(self.zstd.decompress(packed[:size]))
            packed = packed[size:]
        return join_planes(planes, n)

    def ids(self, start: int, count: int) -> np.ndarray:
        """Any range of the shard's ids, from the blocks that hold it."""
        count = min(count, self.n_ids - start)
        if count <= 0:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        whole = np.frombuffer(b"".join(self.block(b) for b in range(first, last + 1)), "<u4")
        return whole[start - first * self.block_ids:][:count]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, ids before it in the shard, number of ids, crc32 of its ids), block by block."""
        rest, number, start = b"", 0, 0
        for doc_id, n in zip(self.doc_ids, self.lengths.tolist(), strict=True):
            crc, missing = 0, 4 * n
            while missing:
                if not rest:
                    rest, number = self.block(number), number + 1
                part, rest = rest[:missing], rest[missing:]
                crc, missing = zlib.crc32(part, crc), missing - len(part)
            yield doc_id, start, n, crc
            start += n


def split_planes(ids: bytes, planes: int) -> list[bytes]:
    cells = np.frombuffer(ids, "u1").reshape(-1, 4)
    if planes == BYTES:
        return [cells[:, i].tobytes() for i in range(4)]
    return [np.packbits((cells[:, i // 8] >> (i % 8)) & 1).tobytes() for i in range(32)]


def join_planes(planes: list[bytes], n: int) -> bytes:
    cells = np.zeros((n, 4), "u1")
    if len(planes) == BYTES:
        for i, plane in enumerate(planes):
            cells[:, i] = np.frombuffer(plane, "u1")
    else:
        for i, plane in enumerate(planes):
            if plane.strip(b"\0"):
                cells[:, i // 8] |= np.unpackbits(np.frombuffer(plane, "u1"), count=n) << (i % 8)
    return cells.tobytes()

"""Minimal perfect hashing of 32-byte digests, vectorised.

Level by level, every digest not yet placed is hashed into a table of about twice their number; those
alone in their cell get the cell's rank as their slot, the rest go on. n digests take the slots 0 to
n - 1. A digest that was never placed ends in some slot or in none: who asks must compare the bytes.
"""

from __future__ import annotations

import numpy as np

from orderloom.llm.shingles import mixed

WIDTH = 32


def words(digests: bytes) -> np.ndarray:
    """Concatenated digests as rows of four integers."""
    return np.frombuffer(digests, "<u8").reshape(-1, WIDTH // 8)


def cells(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    """A new hash on each level; levels take turns with the four words, so digests that differ
    anywhere part at last."""
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mixed(digests[:, level % 4] + seed) % np.uint64(size)).astype("i8")


def build(digests: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """(cells of each level, their bits, slot of each digest). The digests must be distinct."""
    slots = np.empty(len(digests), "i8")
    left, placed, sizes, bits = np.arange(len(digests)), 0, [], []
    while len(left):
        size = 8 * (len(left) // 4 + 1)
        at = cells(digests[left], len(sizes), size)
        single = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(single) - 1 + placed
        alone = single[at]
        slots[left[alone]] = rank[at[alone]]
        left, placed = left[~alone], placed + int(single.sum())
        sizes.append(size)
        bits.append(np.packbits(single).tobytes())
    return sizes, b"".join(bits), slots


def find(digests: np.ndarray, sizes: list[int], bits: bytes) -> np.ndarray:
    """The slot each digest would have, -1 for those that no level places."""
    slots = np.full(len(digests), -1, "i8")
    left, placed, first = np.arange(len(digests)), 0, 0
    for level, size in enumerate(sizes):
        single = np.unpackbits(np.frombuffer(bits, "u1", size // 8, first)).astype(bool)
        rank = np.cumsum(single) - 1 + placed
        at = cells(digests[left], level, size)
        alone = single[at]
        slots[left[alone]] = rank[at[alone]]
        left, placed, first = left[~alone], placed + int(single.sum()), first + size // 8
    return slots

"""Sets of word shingles as hashes, and what an index needs of a set.

A set is cut into parts by a hash of its members. Two sets that link differ in at most H members,
so of more than H parts at least one is the same in both. Sizes fall into classes such that linked
sets are in one class or in neighbouring ones; a set is indexed in its own class and the one below,
by the signatures of its first H + 1 parts that are not empty. A signature covers about ten members
(at nine tenths), so a passage that a third of the corpus shares makes no long list by itself.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

from orderloom.llm.common import worker_memory

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Words whose hash is kept in a worker; then the memory is emptied.
KEPT_WORDS = 500_000
BITMAP = 512
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return (x ^ (x >> np.uint64(27))) * _A


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted hashes of the distinct k-word shingles; a shorter text is one shingle."""
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return np.zeros(0, "u8")
    kept = worker_memory("shingles")
    if len(kept) > KEPT_WORDS:
        kept.clear()
    found = list(map(kept.get, words))
    if None in found:
        for i, h in enumerate(found):
            if h is None:
                found[i] = kept[words[i]] = xxhash.xxh3_64_intdigest(words[i])
    h = np.array(found, "u8")
    n = max(1, len(words) - k + 1)
    width = min(k, len(words))
    rolled = np.full(n, width, "u8")
    for i in range(width):
        rolled = mixed(rolled + h[i:i + n] * _A)
    return np.unique(rolled)


def class_bounds(size: int, percent: int) -> tuple[int, int]:
    """(class of this size, largest size in it). A class ends where a set of its least size cannot
    link any more; so linked sets are at most one class apart.
    """
    number, least = 0, 1
    while True:
        most = least * 100 // percent
        if size <= most:
            return number, most
        number, least = number + 1, most + 1


def signatures(members: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of the parts by which a set is indexed, in its class and the one below."""
    number, most = class_bounds(len(members), percent)
    below = _class_most(number - 1, percent)
    return np.concatenate([_parts(members, c, m, percent) for c, m in
                           ((number, most), (number - 1, below)) if c >= 0])


def _class_most(number: int, percent: int) -> int:
    most = 0
    for _ in range(number + 1):
        most = (most + 1) * 100 // percent
    return most


def _parts(members: np.ndarray, number: int, most: int, percent: int) -> np.ndarray:
    differ = most * (100 - percent) // percent  # the smaller of two linked sets is in this class
    parts = differ + 3 + differ // 16
    seed = np.uint64((number + 1) * int(_A) & (1 << 64) - 1)
    dealt = (mixed(members ^ seed) % np.uint64(parts)).astype("i8")
    sums = np.zeros(parts, "u8")
    np.add.at(sums, dealt, mixed(members + seed))
    filled = np.flatnonzero(np.bincount(dealt, minlength=parts))
    if len(filled) > differ:
        chosen = filled[:differ + 1]
    else:  # few members: empty parts count as equal, too
        chosen = np.arange(parts)
    return mixed(sums[chosen] ^ mixed(seed + chosen.astype("u8")))


def bitmap(members: np.ndarray) -> np.ndarray:
    """Parity of the members per cell. Two sets differ in no fewer members than bits."""
    cells = np.bincount((members >> np.uint64(7)).astype("i8") & (BITMAP - 1), minlength=BITMAP) & 1
    return np.packbits(cells.astype("u1")).view("<i8")

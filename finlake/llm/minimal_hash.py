"""Minimal perfect hash over distinct 32-byte digests, built level by level with numpy.

Each level maps the digests left to a bit array; those alone in their cell stay, the others go to the next level.
The slot of a digest is the rank of its bit, so n digests take the slots 0 to n - 1. A digest that was not among
them may also reach a slot: the caller compares the digest stored there.
"""

from __future__ import annotations

import numpy as np

CELLS_PER_KEY = 1.5


def _cells(words: np.ndarray, level: int, size: int) -> np.ndarray:
    x = words[:, level % 4] + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def words_of(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def build(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and the bits of all levels in one array; the digests must be distinct."""
    sizes, parts, left = [], [], words
    while len(left):
        size = int(len(left) * CELLS_PER_KEY) + 1
        cells = _cells(left, len(sizes), size)
        alone = np.bincount(cells, minlength=size) == 1
        sizes.append(size)
        parts.append(alone)
        left = left[~alone[cells]]
    return sizes, np.concatenate(parts) if parts else np.zeros(0, bool)


def slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 where no level takes it."""
    rank = np.cumsum(bits) - 1
    out = np.full(len(words), -1, np.int64)
    open_rows, start = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        if not len(open_rows):
            break
        at = _cells(words[open_rows], level, size) + start
        hit = bits[at]
        out[open_rows[hit]] = rank[at[hit]]
        open_rows, start = open_rows[~hit], start + size
    return out

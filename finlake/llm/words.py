"""Words of texts as 64-bit hashes, whole Arrow batches at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash

MAX_CACHED = 1 << 19
CHUNK_WORDS = 1 << 18

# Lower-cases A-Z and turns every ASCII byte but letters and digits into a space; other bytes stay.
_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def spaced_words(data: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return data.lower().split()


def alnum_words(data: bytes) -> list[bytes]:
    """Runs of a-z, 0-9 and non-ASCII characters, A-Z lower-cased."""
    return data.translate(_ALNUM).split()


class WordHashes(dict):
    """Hash of each word met, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words; empty where there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    return mix(total + np.uint64(k))


def chunks(
    texts: list[bytes], split: Callable[[bytes], list[bytes]], hashes: WordHashes
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, words per text, word hashes) of runs of texts with about CHUNK_WORDS words together."""
    first, counts, parts, held = 0, [], [], 0
    for i, text in enumerate(texts):
        words = split(text)
        counts.append(len(words))
        parts.append(hashes.of(words))
        held += len(words)
        if held >= CHUNK_WORDS or i == len(texts) - 1:
            yield first, np.array(counts, np.int64), np.concatenate(parts)
            first, counts, parts, held = i + 1, [], [], 0

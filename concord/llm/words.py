"""Hashes of words, the same on every machine, through a bounded cache."""

from __future__ import annotations

import re

import numpy as np

CACHE = 400_000
LONG = 64  # bytes; longer words are not kept, so a cache is bounded in bytes
PUNCTUATION = re.compile(r"[\W_]+")


def plain(word: bytes) -> bytes:
    """Letters and digits of a word, lower case."""
    return PUNCTUATION.sub("", word.decode("utf-8", "replace").lower()).encode()


class WordHash(dict):
    """64-bit hash of a word, as a signed integer; of plain(word) if asked for, 0 where that is empty."""

    def __init__(self, plain_words: bool = False):
        import xxhash

        self.digest, self.plain = xxhash.xxh3_64_intdigest, plain_words

    def __missing__(self, word: bytes) -> int:
        key = plain(word) if self.plain else word
        h = self.digest(key)
        value = (h - (1 << 64) if h >> 63 else h) if key or not self.plain else 0
        if len(word) <= LONG:
            if len(self) >= CACHE:
                self.clear()
            self[word] = value
        return value

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of the words of a text between white space, A-Z lowered; plain words that are empty don't count."""
        words = text.lower().split()
        h = np.fromiter(map(self.__getitem__, words), np.int64, len(words)).view(np.uint64)
        return h[h != 0] if self.plain else h


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit hashes that spreads all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


ODD = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) ** 3 % (1 << 64) | 1) for i in range(64)]


def windows(h: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """For each position at which all offsets fit, a hash of the words at these offsets in order."""
    n = len(h) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, at in enumerate(offsets):
        total += (h[at:at + n] ^ (h[at:at + n] >> np.uint64(31))) * ODD[i % 64] if i < 64 else mix(h[at:at + n] + np.uint64(i))
    return mix(total)

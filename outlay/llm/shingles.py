"""Word shingles of documents as 64-bit numbers, and their minima (runs inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
_REMEMBERED_WORDS = 300_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FINISH = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """word bytes -> 64-bit hash; forgets all when full, which changes no value."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def words_of(text: str) -> list[bytes]:
    """Lower-case A-Z and split at white space: exactly what ``bytes`` methods do on ASCII."""
    return text.encode().lower().split()


def shingle_set(words: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``width`` are one shingle, none are none."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    rolled = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        rolled = rolled * _MIX + words[k : n - width + 1 + k]
    rolled = (rolled ^ (rolled >> np.uint64(32))) * _FINISH
    return np.unique(rolled ^ (rolled >> np.uint64(29)))


def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd factors and offsets of ``count`` multiply-add hash functions."""
    draw = np.random.Generator(np.random.PCG64(20_240_229))
    return (
        draw.integers(0, 2**64, count, dtype=np.uint64) | np.uint64(1),
        draw.integers(0, 2**64, count, dtype=np.uint64),
    )


def minima(sets: list[np.ndarray], functions: tuple[np.ndarray, np.ndarray], chunk: int = 8192) -> np.ndarray:
    """16 bits of each hash function's minimum over each (non-empty) set.

    A minimum of many values is small, so it is mixed before bits are taken.
    Sets are cut into chunks that stay in the processor's cache; a chunk's
    minima are combined with those of the same set's other chunks.
    """
    factors, offsets = functions
    least = np.full((len(sets), len(factors)), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for at in range(0, len(flat), chunk):
        part, owners = flat[at : at + chunk], owner[at : at + chunk]
        starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
        rows = owners[starts]
        for k in range(len(factors)):
            found = np.minimum.reduceat(part * factors[k] + offsets[k], starts)
            least[rows, k] = np.minimum(least[rows, k], found)
    least *= _FINISH
    least ^= least >> np.uint64(32)
    return (least * _MIX >> np.uint64(48)).astype(np.uint16)

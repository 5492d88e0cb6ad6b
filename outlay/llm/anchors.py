"""Anchors and window hashes of byte strings (runs inside tasks).

For a start position i the anchor is the leftmost position with the smallest
8-byte hash among i .. i + REACH - 1. It depends on the bytes from i on only, so
equal 200-byte strings have their anchors at the same offset. Starts with one
anchor are consecutive; such a run is a segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Length of the repeated strings.
LENGTH = 200
#: Starts within this distance before an anchor may have it.
REACH = 128
#: Every string with an anchor covers this many bytes from the anchor on.
CORE = LENGTH - REACH + 1
#: All strings with one anchor lie in these bytes: REACH - 1 before it, LENGTH from it on.
CONTEXT = REACH - 1 + LENGTH
_GRAM = 8
#: Positions of one stretch fit into 16 bits.
_PIECE = 60_000

_draw = np.random.Generator(np.random.PCG64(6_200))
#: Two independent hashes: random values of the 256 bytes and of the outside, and an odd base with its inverse.
_VALUES = [_draw.integers(0, 2**64, 257, dtype=np.uint64) for _ in range(2)]
_BASES = [int(_draw.integers(0, 2**63)) * 2 + 1 for _ in range(2)]


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base & (2**64 - 1), dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


_UP = [_powers(b, _PIECE + 4 * CONTEXT) for b in _BASES]
_DOWN = [_powers(pow(b, -1, 2**64), _PIECE + 4 * CONTEXT) for b in _BASES]


class WindowHashes:
    """Hashes of windows of one byte string; positions before and after it count as the outside."""

    def __init__(self, data: np.ndarray, before: int = 0, after: int = 0) -> None:
        self.before = before
        self.symbols = np.full(before + len(data) + after, 256, dtype=np.int16)
        self.symbols[before : before + len(data)] = data
        self.sums: dict[int, np.ndarray] = {}

    def _sums(self, which: int) -> np.ndarray:
        if which not in self.sums:
            total = np.zeros(len(self.symbols) + 1, dtype=np.uint64)
            np.cumsum(_VALUES[which][self.symbols] * _DOWN[which][: len(self.symbols)], out=total[1:])
            self.sums[which] = total
        return self.sums[which]

    def at(self, starts: np.ndarray, length: int, which: int) -> np.ndarray:
        first = starts + self.before
        total = self._sums(which)
        value = (total[first + length] - total[first]) * _UP[which][first]
        return (value ^ (value >> np.uint64(31))).view(np.int64)


def _anchors(data: np.ndarray, starts: int) -> np.ndarray:
    """The anchor of each of the first ``starts`` positions."""
    count = starts + REACH - 1
    grams = np.ndarray((count,), dtype="<u8", buffer=data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    # The hash in the upper half, the position in the lower: the smallest is leftmost among equals.
    least = (grams >> np.uint64(32)).astype(np.uint32)
    least ^= least >> np.uint32(15)
    least *= np.uint32(0x85EBCA6B)
    least &= np.uint32(0xFFFF0000)
    least |= np.arange(count, dtype=np.uint32)
    step = 1
    while step < REACH:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return (least & np.uint32(0xFFFF)).astype(np.int64)


class Segments:
    """Segments of a stretch of one text: anchors, first and last starts (places in the text), and hashes."""

    def __init__(self, data: np.ndarray, offset: int, anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        self.anchor, self.first, self.last = anchor, first, last
        self.low = max(0, offset - REACH)
        self.data = data
        self.high = min(len(data), (int(anchor[-1]) if len(anchor) else 0) + LENGTH)
        self._hashes: WindowHashes | None = None

    def _hash(self, starts: np.ndarray, length: int, which: int) -> np.ndarray:
        if self._hashes is None:
            self._hashes = WindowHashes(self.data[self.low : self.high], REACH, LENGTH)
        return self._hashes.at(starts - self.low, length, which)

    def cores(self, which: int = 0) -> np.ndarray:
        return self._hash(self.anchor, CORE, which)

    def contexts(self, which: int) -> np.ndarray:
        return self._hash(self.anchor - (REACH - 1), CONTEXT, which)

    def context_bytes(self, chosen: np.ndarray) -> list[bytes]:
        """The context of each chosen segment; bytes outside the text are zero."""
        padded = np.zeros(REACH + self.high - self.low + LENGTH, dtype=np.uint8)
        padded[REACH : REACH + self.high - self.low] = self.data[self.low : self.high]
        begin = self.anchor[chosen] - (REACH - 1) - self.low + REACH
        return [padded[b : b + CONTEXT].tobytes() for b in begin]


def segments(data: np.ndarray) -> Iterator[Segments]:
    """All segments of a text, in stretches of bounded size; none if it is shorter than LENGTH."""
    end = len(data) - LENGTH + 1
    at = 0
    while at < end:
        upto = min(end, at + _PIECE)
        anchors = _anchors(data[at : upto + REACH + _GRAM - 2], upto - at)
        cuts = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        if upto < end:  # the last segment may go on: it opens the next stretch
            upto = at + int(cuts[-1])
            anchors = anchors[: cuts[-1]]
            cuts = cuts[:-1]
        first = np.r_[0, cuts]
        last = np.r_[cuts, len(anchors)] - 1
        yield Segments(data, at, anchors[first] + at, first + at, last + at)
        at = upto


def context_window_hashes(contexts: np.ndarray) -> list[np.ndarray]:
    """Both hashes of the LENGTH-byte windows at columns 0 .. REACH - 1 of each context (rows)."""
    found = []
    for values, down, up in zip(_VALUES, _DOWN, _UP):
        total = np.zeros((len(contexts), CONTEXT + 1), dtype=np.uint64)
        np.cumsum(values[contexts] * down[:CONTEXT], axis=1, out=total[:, 1:])
        found.append((total[:, LENGTH : LENGTH + REACH] - total[:, :REACH]) * up[:REACH])
    return found

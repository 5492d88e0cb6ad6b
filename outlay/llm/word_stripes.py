"""Stripes of a batch of texts: next-word counters of word sequences (runs inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from outlay.llm.bit_filter import passes

#: Longest phrase, in words.
LONGEST = 5
#: A stripe is split by its next words so that a part holds about so small a share of all words.
SHARES = 4096
#: Words counted before their stripes are handed on, and distinct words known at once.
WORDS_AT_ONCE = 4_000_000
KNOWN_WORDS = 1_000_000
#: Bytes of a text that are split into words at once.
SLICE_BYTES = 1 << 20
_ROWS_AT_ONCE = 20_000
_BITS = 21  # a word's number: three fit into 63 bits
_DELIMITERS = b".,;:!?\n\x0b\x0c\r"
#: 0xFF is no byte of UTF-8 text, so it can stand for the end of a piece.
_MARKED = bytes.maketrans(_DELIMITERS, b"\xff" * len(_DELIMITERS))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> Iterator[list[bytes]]:
    """Lower-case words of a text in order, slice by slice; the byte 0xFF stands between pieces."""
    data = text.encode().lower().translate(_MARKED)
    at = 0
    while at < len(data):
        end = at + SLICE_BYTES
        if end < len(data):
            # Cut behind a blank or a delimiter, so no word is cut: the last one inside, or the next one.
            cut = max(data.rfind(mark, at, end) for mark in (b" ", b"\t", b"\xff"))
            if cut < 0:
                found = [place for mark in (b" ", b"\t", b"\xff") if (place := data.find(mark, end)) >= 0]
                cut = min(found, default=len(data) - 1)
            end = cut + 1
        yield data[at:end].replace(b"\xff", b" \xff ").split()
        at = end


def gram_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of ``length`` words from each place on, given the hashes of the words."""
    rolled = words.copy()
    for k in range(1, length):
        rolled = rolled[:-1] * _MIX + words[k:]
    return (rolled ^ (rolled >> np.uint64(31))) * _MIX


class _Numbers(dict):
    """word -> number in the order of first sight."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def word_hash(word: bytes, lang: str) -> int:
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh32_intdigest(lang))


class Hot:
    """Prefixes that hold at least a share of all words, at most ``SHARES`` of them, and their number of parts."""

    def __init__(self, hashes: list[int], counts: list[int], total: int) -> None:
        order = np.argsort(np.array(hashes, dtype=np.uint64))
        self.hashes = np.array(hashes, dtype=np.uint64)[order]
        self.parts = np.array([-(-n * SHARES // total) for n in counts], dtype=np.int64)[order]

    def parts_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.parts[at], 1)


class Stripes:
    """Collects texts of one language and gives their stripes for prefixes of ``length`` words.

    ``frequent`` is a bit field over hashes of the sequences of ``length`` words
    that are frequent enough; a place counts if its prefix may be one, and its
    next word is told apart if the sequence that ends with it may be one, too.
    Otherwise, and at the end of a piece, the counter of the empty word grows,
    so a stripe's sum is the number of places of its prefix. Without ``ends``
    such places are left out, and with them the stripes that hold nothing else.
    """

    def __init__(self, lang: str, length: int, frequent: np.ndarray | None, hot: Hot | None = None, ends: bool = True) -> None:
        self.lang, self.length, self.frequent, self.ends = lang, length, frequent, ends
        self.hot = hot or Hot([], [], 1)
        self._start()

    def _start(self) -> None:
        self.numbers, self.parts, self.count = _Numbers(), [], 0

    def add(self, text: str) -> None:
        number = self.numbers.__getitem__
        self.numbers[b"\xff"]  # the break is number 0
        for words in tokens(text):
            self.parts.append(np.fromiter(map(number, words), dtype=np.int32, count=len(words)))
            self.count += len(words)
        self.parts.append(np.zeros(1, dtype=np.int32))

    def full(self) -> bool:
        return self.count > WORDS_AT_ONCE or len(self.numbers) > KNOWN_WORDS

    def flush(self) -> Iterator[pa.RecordBatch]:
        """``lang, prefix, part, next, n`` of what was added."""
        if not self.count:
            return
        if len(self.numbers) >= 1 << _BITS:
            raise ValueError("one text holds more distinct words than can be numbered")
        placed = np.concatenate(self.parts)
        known = list(self.numbers)
        names = pa.array([word.decode() if word != b"\xff" else "" for word in known])
        hashes = np.fromiter((word_hash(word, self.lang) for word in known), dtype=np.uint64, count=len(known))
        self._start()
        length = self.length
        if length:
            starts = np.flatnonzero(self._inside(placed, length)).astype(np.int32)
            prefixes = gram_hashes(hashes[placed], length)
            may = np.zeros(len(placed), dtype=bool)
            may[starts] = True if self.frequent is None else passes(self.frequent, prefixes[starts])
            starts = starts[may[starts]]
            # The texts end with a break, so starts + length is a place.
            after = np.where(may[starts + 1], placed[starts + length], 0)
            if not self.ends:
                starts, after = starts[after != 0], after[after != 0]
            parts = self.hot.parts_of(prefixes[starts])
        else:
            starts = np.flatnonzero(placed)
            after = placed[starts]
            parts = SHARES
        if len(starts):
            columns = [placed[starts + k] for k in range(length)]
            part = (hashes[after] >> np.uint64(20)).astype(np.int64) % parts
            part[after == 0] = 0
            yield from self._stripes(columns, part, after, names)

    @staticmethod
    def _inside(placed: np.ndarray, length: int) -> np.ndarray:
        """Places from which ``length`` words follow without a break."""
        inside = placed != 0
        for k in range(1, length):
            inside[:-k] &= placed[k:] != 0
            inside[-k:] = False
        return inside

    def _stripes(self, prefix: list[np.ndarray], part: np.ndarray, after: np.ndarray, names: pa.Array) -> Iterator[pa.RecordBatch]:
        # Sort by prefix, part and next word; three words are one number.
        keys = [after | part << _BITS]
        for k in range(0, len(prefix), 3):
            keys.append(sum(word.astype(np.int64) << (_BITS * i) for i, word in enumerate(prefix[k : k + 3])))
        order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0])
        first = _changes([key[order] for key in keys])
        counts = np.diff(np.append(first, len(order)))
        rows = order[first]
        after, part = after[rows], part[rows]
        begins = _changes([part, *[word[rows] for word in prefix]])
        heads = [names.take(pa.array(word[rows[begins]])) for word in prefix]
        joined = pc.binary_join_element_wise(*heads, " ") if heads else pa.array([""] * len(begins))
        begins = np.append(begins, len(rows))
        for at in range(0, len(begins) - 1, _ROWS_AT_ONCE):
            ends = begins[at : at + _ROWS_AT_ONCE + 1]
            offsets = pa.array((ends - ends[0]).astype(np.int32))
            inside = slice(ends[0], ends[-1])
            n = len(ends) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([self.lang] * n),
                    joined.slice(at, n),
                    pa.array(part[ends[:-1]].astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, names.take(pa.array(after[inside]))),
                    pa.ListArray.from_arrays(offsets, pa.array(counts[inside].astype(np.int32))),
                ],
                names=["lang", "prefix", "part", "next", "n"],
            )


def _changes(keys: list[np.ndarray]) -> np.ndarray:
    """Places at which a row differs from the one before."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)

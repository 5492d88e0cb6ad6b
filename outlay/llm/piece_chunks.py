"""Word-piece segmentation of single chunks (runs inside tasks).

White space becomes the marker U+2581. A chunk is a run of markers and the
characters up to the next marker; the text gets one marker in front. No piece
of the vocabulary has a marker behind another character, so merging never
crosses the border of two chunks: each can be segmented alone, and the ids of
a text are those of its chunks in order. A chunk holds
whole characters, so decoding works chunk by chunk as well.

Where the vocabulary allows it, a chunk ends elsewhere, too: between a sign and a
letter if no piece has that sign beside a letter, and around a sign that no piece
has beside anything (``free_signs``). So "word", "word," and "word." share the
chunk of the word.

Within a chunk the neighbours whose joint piece has the best score are merged,
leftmost first, until none is left. A character that is no piece becomes its
UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

MARKER = "▁"
#: ASCII characters besides letters and digits.
ASCII_SIGNS = "".join(c for c in map(chr, range(128)) if not c.isalnum() and c != " ")
#: Up to this many characters the best neighbours are searched in a list, beyond it in a heap.
SHORT = 64


@dataclass(frozen=True)
class Vocabulary:
    """What segmentation needs of a model: its size is that of the model file."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: tuple[int, ...]
    begin: int
    end: int
    pieces: list[str] = field(repr=False, default_factory=list)
    signs: str = ""
    alone: str = ""

    def chunk_pattern(self) -> re.Pattern[str]:
        """What one chunk is."""
        lone = re.escape(self.alone)
        rest = rf"[^{MARKER}{lone}]+" + (f"|[{lone}]+" if lone else "")
        if self.signs:
            # A run of letters or signs that ends where the other kind follows, or nothing that may join it.
            free, letter, end = f"[{re.escape(self.signs)}]", r"[^\W\d_]", rf"[{MARKER}{lone}]|\Z"
            rest = f"{letter}+(?={free}|{end})|{free}+(?={letter}|{end})|{rest}"
        return re.compile(f"{MARKER}*(?:{rest})|{MARKER}+")


def free_signs(pieces: Iterable[str]) -> tuple[str, str]:
    """The ASCII signs that are beside no letter in any piece, and those that are beside no character at all."""
    beside = {piece[i : i + 2] for piece in pieces for i in range(len(piece) - 1)}
    mixed = {c for pair in beside if pair[0].isalpha() != pair[1].isalpha() for c in pair}
    joined = {c for pair in beside for c in pair}
    return "".join(sign for sign in ASCII_SIGNS if sign not in mixed), "".join(sign for sign in ASCII_SIGNS if sign not in joined)


def load_vocabulary(path: str) -> Vocabulary:
    """The pieces of a model file, read through the library that defines the format."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.vocab_size()
    pieces = [model.id_to_piece(i) for i in range(count)]
    plain = [i for i in range(count) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    for i in plain:
        if MARKER in pieces[i].lstrip(MARKER):
            raise ValueError(f"piece {i} crosses a marker: chunks cannot be segmented alone")
    byte_ids = tuple(i for i in range(count) if model.is_byte(i))
    if len(byte_ids) != 256 or MARKER not in pieces:
        raise ValueError("the vocabulary must hold the marker and all 256 bytes")
    if model.normalize("ﬁ  a\t") != f"{MARKER}ﬁ{MARKER}{MARKER}a\t":
        raise ValueError("the model changes texts beyond marking white space")
    signs, alone = free_signs(pieces[i] for i in plain)
    return Vocabulary(
        ids={pieces[i]: i for i in plain},
        scores={pieces[i]: model.get_score(i) for i in plain},
        byte_ids=byte_ids,
        begin=model.bos_id(),
        end=model.eos_id(),
        pieces=pieces,
        signs=signs,
        alone=alone,
    )


def chunks(text: str, pattern: re.Pattern[str]) -> list[str]:
    """The marked words of a text; an empty text has none."""
    return pattern.findall(MARKER + text.replace(" ", MARKER)) if text else []


class Segmenter:
    """Ids of a chunk, and its characters back from ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        # Smaller is better, so that ties fall to the leftmost.
        self._cost = {piece: -score for piece, score in vocabulary.scores.items()}
        self._byte_of = {i: byte for byte, i in enumerate(vocabulary.byte_ids)}
        self._control = {vocabulary.begin, vocabulary.end}

    def _merged(self, chunk: str) -> list[str]:
        if len(chunk) > SHORT:
            return self._merged_long(chunk)
        cost, none = self._cost.get, float("inf")
        parts = list(chunk)
        costs = [cost(a + b, none) for a, b in zip(parts, parts[1:])]
        while costs and (least := min(costs)) != none:
            i = costs.index(least)
            parts[i : i + 2] = [both := parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = cost(parts[i - 1] + both, none)
            if i < len(costs):
                costs[i] = cost(both + parts[i + 1], none)
        return parts

    def _merged_long(self, chunk: str) -> list[str]:
        cost, n = self._cost, len(chunk)
        parts = list(chunk)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting: list[tuple[float, int, int]] = []

        def offer(i: int, j: int) -> None:
            both = cost.get(parts[i] + parts[j])
            if both is not None:
                heapq.heappush(waiting, (both, i, len(parts[i]) + len(parts[j])))

        for i in range(n - 1):
            offer(i, i + 1)
        while waiting:
            _, i, length = heapq.heappop(waiting)
            j = after[i]
            # Parts only grow, so a waiting pair is still there if its length is.
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != length:
                continue
            parts[i], parts[j] = parts[i] + parts[j], ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [part for part in parts if part]

    def encode_chunk(self, chunk: str) -> list[int]:
        ids, byte_ids = self.vocabulary.ids, self.vocabulary.byte_ids
        found: list[int] = []
        for part in self._merged(chunk):
            known = ids.get(part)
            if known is None:
                found.extend(byte_ids[byte] for byte in part.encode())
            else:
                found.append(known)
        return found

    def decode_marked(self, ids: list[int]) -> str:
        """The characters of ids, markers included; control ids are nothing."""
        pieces, byte_of = self.vocabulary.pieces, self._byte_of
        out: list[str] = []
        run = bytearray()
        for i in ids:
            byte = byte_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()
            if i not in self._control:
                out.append(pieces[i])
        if run:
            out.append(run.decode(errors="replace"))
        return "".join(out)


def unmarked(marked: str) -> str:
    """The text of marked characters: the marker put in front goes, the others become spaces."""
    return marked.removeprefix(MARKER).replace(MARKER, " ")


class ChunkTable(dict):
    """chunk -> (ids as little-endian 32-bit numbers, decoded characters).

    It starts with the shared rows. Other chunks are added when they are met.
    When they fill half the room, all become the old generation, from which
    chunks in use come back; the one before goes, which changes no value.
    Chunks above ``LONG`` characters are not remembered.
    """

    LONG = 256

    def __init__(self, segmenter: Segmenter, shared: dict[str, tuple[bytes, str]], room: int) -> None:
        super().__init__(shared)
        self.segmenter, self.shared, self.room, self.used = segmenter, shared, room, 0
        self.old: dict[str, tuple[bytes, str]] = {}

    def __missing__(self, chunk: str) -> tuple[bytes, str]:
        value = self.old.get(chunk)
        if value is None:
            ids = self.segmenter.encode_chunk(chunk)
            value = (np.asarray(ids, dtype="<u4").tobytes(), self.segmenter.decode_marked(ids))
        if len(chunk) <= self.LONG:
            self[chunk] = value
            self.used += 300 + 8 * len(chunk)  # about what the entry takes
        return value

    def turn(self) -> None:
        """Between texts: begin a new generation when the added chunks fill half the room."""
        if self.used > self.room // 2:
            self.old = dict(self)
            self.clear()
            self.update(self.shared)
            self.used = 0

"""Byte-level BPE by tree reduction.

A text is cut by the tokenizer's pattern; each piece is encoded on its own. A
piece is encoded in halves, recursively, and the halves are joined: the tokens
nearest the cut are merged anew over a window that grows until the tokens just
outside it are stable.

Why that is enough: call two neighbouring tokens stable if encoding their joint
bytes gives back exactly these two. A token sequence whose neighbours are all
stable is the encoding of its bytes. (Take the first merge that would cross a
token border. All merges before it stayed inside tokens, so encoding the two
tokens alone makes the same merges in the same order and then crosses the
border as well, against stability.) Inside each half all neighbours are stable,
inside the window too, so only the two window borders need a check.

Decoding concatenates bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import regex

#: Pieces up to this many bytes are merged directly.
LEAF_BYTES = 6
#: Up to this many bytes the lowest rank is searched in a list.
SHORT_BYTES = 96
#: Distinct pieces in one generation of a worker's memory; two are kept.
CACHE_PIECES = 200_000
_REMEMBERED = 300_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """Encoder and decoder for one rank table and one piece pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = _REMEMBERED) -> None:
        self.ranks = ranks
        self._remembered = remembered
        self.pattern = regex.compile(pattern)
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self._no_rank = max(ranks.values(), default=0) + 1
        self._merged: dict[bytes, list[bytes]] = {}
        self._stable: dict[tuple[bytes, bytes], bool] = {}

    def _merge_short(self, data: bytes) -> list[bytes]:
        """``_merge`` for few bytes: a plain search for the lowest rank is faster than a heap."""
        known = self._merged.get(data)
        if known is not None:
            return known
        rank_of, none = self.ranks.get, self._no_rank
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [rank_of(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) != none:
            i = ranks.index(lowest)
            parts[i : i + 2] = [both := parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] + both, none)
            if i < len(ranks):
                ranks[i] = rank_of(both + parts[i + 1], none)
        if len(data) <= 2 * LEAF_BYTES:
            if len(self._merged) > self._remembered:
                self._merged.clear()
            self._merged[data] = parts
        return parts

    def _merge(self, data: bytes) -> list[bytes]:
        """Merge the neighbours of lowest rank, leftmost first, until none is left."""
        if len(data) <= SHORT_BYTES:
            return self._merge_short(data)
        ranks, n = self.ranks, len(data)
        parts: list[bytes] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = []
        for i in range(n - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                waiting.append((rank, i, data[i : i + 2]))
        heapq.heapify(waiting)
        while waiting:
            _, i, both = heapq.heappop(waiting)
            j = after[i]
            # Parts only grow, so a pair is the one that waited if its bytes still are.
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != len(both):
                continue
            parts[i], parts[j] = both, b""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(both + parts[k])
                if rank is not None:
                    heapq.heappush(waiting, (rank, i, both + parts[k]))
            h = before[i]
            if h >= 0:
                rank = ranks.get(parts[h] + both)
                if rank is not None:
                    heapq.heappush(waiting, (rank, h, parts[h] + both))
        return [part for part in parts if part]

    def _is_stable(self, left: bytes, right: bytes) -> bool:
        key = (left, right)
        found = self._stable.get(key)
        if found is None:
            if len(self._stable) > self._remembered:
                self._stable.clear()
            found = self._stable[key] = self._merge(left + right) == [left, right]
        return found

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of two encoded neighbours."""
        if not left or not right:
            return left + right
        a, b = len(left), 0
        middle: list[bytes] = []
        grow_left = grow_right = not self._is_stable(left[-1], right[0])
        step = 1
        while grow_left or grow_right:
            a = max(0, a - step) if grow_left else a
            b = min(len(right), b + step) if grow_right else b
            step *= 2
            middle = self._merge(b"".join(left[a:]) + b"".join(right[:b]))
            grow_left = a > 0 and not self._is_stable(left[a - 1], middle[0])
            grow_right = b < len(right) and not self._is_stable(middle[-1], right[b])
        return left[:a] + middle + right[b:]

    def _tree(self, data: bytes) -> list[bytes]:
        if len(data) <= LEAF_BYTES:
            return self._merge(data)
        half = len(data) // 2
        return self.join(self._tree(data[:half]), self._tree(data[half:]))

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece; a piece that is a token itself is that token."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else [self.ranks[token] for token in self._tree(piece)]

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode(self, text: str) -> list[int]:
        return [token for piece in self.pieces(text) for token in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a token sequence, concatenated by halves."""
        if len(ids) <= 64:
            return b"".join(self.token_bytes[i] for i in ids)
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class _Pieces(dict):
    """piece -> (its ids as text, the bytes decoded from the ids), computed once.

    A full generation becomes the old one, from which pieces in use come back.
    """

    def __init__(self, bpe: ByteBpe) -> None:
        self.bpe = bpe
        self.old: dict[str, tuple[str, bytes]] = {}

    def __missing__(self, piece: str) -> tuple[str, bytes]:
        value = self.old.get(piece)
        if value is None:
            ids = self.bpe.encode_piece(piece.encode())
            value = (",".join(map(str, ids)), self.bpe.decode(ids))
        self[piece] = value
        return value

    def turn(self) -> None:
        if len(self) > CACHE_PIECES:
            self.old = dict(self)
            self.clear()


def coded(texts: Iterable[str], pieces: _Pieces) -> Iterator[tuple[int, str, bytes]]:
    """Number of ids, ids joined by commas, and decoded bytes of each text."""
    for text in texts:
        pieces.turn()
        found = pieces.bpe.pieces(text)
        if not found:
            yield 0, "", b""
            continue
        parts, decoded = zip(*map(pieces.__getitem__, found))
        ids = ",".join(parts)
        yield ids.count(",") + 1, ids, b"".join(decoded)


def digests(texts: Iterable[str], pieces: _Pieces) -> Iterator[tuple[int, str, str]]:
    for n, ids, decoded in coded(texts, pieces):
        yield n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()

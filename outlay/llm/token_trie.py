"""Token counts by dynamic programming over a trie of pre-tokens (runs inside tasks).

A pre-token is segmented into vocabulary pieces so that the sum of the pieces'
unigram scores is largest (then the number of pieces smallest). The best score
of a prefix does not depend on what follows, so all pre-tokens go into one
trie and each trie node is scored once for every pre-token that passes it. The
piece count of a pre-token is stored at the node where it ends.
"""

from __future__ import annotations

import math

#: Nodes and pre-tokens after which a worker starts a new trie; no count depends on it.
MOST_NODES = 600_000
MOST_PRETOKENS = 400_000


def rank_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Unigram log-probabilities of ranked pieces by Zipf's law: in proportion to 1 / (rank + 1)."""
    total = math.log(math.fsum(1 / (rank + 1) for rank in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


class TokenTrie:
    """Pre-token -> number of tokens. ``scores`` must hold every single byte."""

    def __init__(self, scores: dict[bytes, float]) -> None:
        missing = [b for b in range(256) if bytes([b]) not in scores]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.scores = scores
        self.longest = max(map(len, scores))
        self._start()

    def _start(self) -> None:
        self.next: dict[int, int] = {}  # 256 * node + byte -> node
        self.best = [0.0]
        self.pieces = [0]
        self.terminal: dict[str, int] = {}

    def __getitem__(self, pretoken: str) -> int:
        known = self.terminal.get(pretoken)
        if known is None:
            known = self.terminal[pretoken] = self._insert(pretoken.encode())
        return known

    def turn(self) -> None:
        if len(self.best) > MOST_NODES or len(self.terminal) > MOST_PRETOKENS:
            self._start()

    def _insert(self, data: bytes) -> int:
        following, best, pieces, score_of = self.next, self.best, self.pieces, self.scores.get
        path, node = [0], 0
        for end, byte in enumerate(data, 1):
            step = 256 * node + byte
            node = following.get(step, 0)
            if not node:
                top, fewest = -math.inf, 0
                for begin in range(max(0, end - self.longest), end):
                    own = score_of(data[begin:end])
                    if own is not None:
                        before = path[begin]
                        total, count = best[before] + own, pieces[before] + 1
                        if total > top or (total == top and count < fewest):
                            top, fewest = total, count
                node = following[step] = len(best)
                best.append(top)
                pieces.append(fewest)
            path.append(node)
        return pieces[node]

"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import numpy as np

KINDS = ("email", "ip", "card", "phone")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def exact(rows):
    """(doc_id, text) -> list of (doc_id, keep_id, group_size, text_sha256)."""
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    groups = collections.defaultdict(list)
    for (doc_id, _), text in zip(rows, normal):
        groups[text].append(doc_id)
    first = {text: min((i for i in ids if i is not None), default=None) for text, ids in groups.items()}
    return [(doc_id, first[text], len(groups[text]), sha(text)) for (doc_id, _), text in zip(rows, normal)]


def removed(texts, length=200):
    """Per text: bytes, removed bytes, removed runs, digest of what is left."""
    data = [(text or "").encode() for text in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    result = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        result.append((len(d), int(gone.sum()), spans, sha(kept)))
    return result


def shingles(text):
    words = tuple((text or "").encode().lower().split())
    if len(words) < 5:
        return {words} if words else set()
    return {words[i : i + 5] for i in range(len(words) - 4)}


def components(rows):
    """doc_id -> (set size, smallest doc_id reachable); doc_ids are distinct."""
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in sets}


def luhn(digits):
    values = [int(d) for d in digits[::-1]]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def base_spans(text):
    """(start, number of the kind, end) by the contract's own patterns."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def unigram_count(data, scores):
    """Pieces of the best segmentation, the fewest among equally good ones."""
    best = [(0.0, 0)]
    for end in range(1, len(data) + 1):
        options = [
            (best[begin][0] + scores[data[begin:end]], -best[begin][1] - 1)
            for begin in range(end)
            if data[begin:end] in scores
        ]
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def contaminated(docs, items, span=10):
    """(doc_id, item_id) with a shared masked window and enough agreeing words."""
    masks = ("1110110101", "1101011011", "1011101101")
    words = lambda text: [w for w in re.split(r"[^\w]+|_+", (text or "").lower()) if w]
    kept = lambda ws, i, mask: (mask, *(ws[i + k] for k, bit in enumerate(mask) if bit == "1"))
    found, split = set(), {item_id: words(item) for item_id, item in items}
    seeds = collections.defaultdict(list)
    for item_id, q in split.items():
        for j in range(len(q) - span + 1):
            for mask in masks:
                seeds[kept(q, j, mask)].append((item_id, j))
    for doc_id, text in docs:
        d = words(text)
        hit = collections.defaultdict(set)
        for i in range(len(d) - span + 1):
            for mask in masks:
                for item_id, j in seeds.get(kept(d, i, mask), ()):
                    hit[item_id].add(i - j)
        for item_id, diagonals in hit.items():
            q = split[item_id]
            places, stretch = set(), 0
            for diagonal in diagonals:
                equal = [j if 0 <= j + diagonal < len(d) and d[j + diagonal] == q[j] else None for j in range(len(q))]
                places |= {j for j in equal if j is not None}
                stretch = max(
                    [stretch] + [sum(j is not None for j in equal[a : a + 20]) for a in range(max(1, len(q) - 19))]
                )
            if diagonals and (100 * len(places) >= 75 * len(q) or stretch >= 15):
                found.add((doc_id, item_id))
    return found


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)

"""Spelling variants against brute force."""

import collections
import itertools
import random
import re
import zlib

from conftest import REPEATED, ROWS, prose

from outlay.llm.spelling_variants import letters, pivots, prefix_places, spelling_variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    form, count = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        count[w] = len(others)
        top = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 5 * n[w] else None
    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, n[w], count[w], form[w], form[w] and n[form[w]], root(w)) for w in n}


def misspelt(seed, count):
    """Words in many copies, with edited forms that are rarer or nearly as frequent, chains included."""
    draw = random.Random(seed)
    alphabet = "abetnÉüÿ×"
    texts = []
    for _ in range(count):
        word = "".join(draw.choices(alphabet, k=draw.randint(5, 12)))
        copies = draw.choice([5, 6, 30, 300])
        while copies >= 5:
            texts += [word] * copies
            at, letter = draw.randrange(len(word)), draw.choice(alphabet)
            word = draw.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])
            copies //= draw.choice([2, 5, 6])
    draw.shuffle(texts)
    return [(i, draw.choice([" ", ", ", "-"]).join(texts[i * 50 : (i + 1) * 50]).title()) for i in range(len(texts) // 50 + 1)]


def test_spelling_variants(make):
    rows = misspelt(1, 180)
    found = {tuple(r) for r in spelling_variants(make(rows)).select("word", "n", "n_near", "form", "form_n", "root").collect()}
    expected = plain(rows)
    assert found == expected and sum(row[3] is not None for row in expected) > 40
    assert any(row[5] not in (row[0], row[3]) for row in expected)


def test_awkward_rows(make, empty):
    rows = ROWS + REPEATED + [(50, "variant variant variant varient " * 9), (None, "variants variants " * 3), (51, " ".join(f"{w}stone {w}stones" for w in prose(3, 3000).split()))]
    found = {tuple(r) for r in spelling_variants(make(rows)).select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert found == plain(rows) and len(found) > 20
    assert spelling_variants(empty).count() == 0


def test_pivots_do_not_overlap_and_are_the_rarest():
    draw = random.Random(2)
    for _ in range(300):
        word = "".join(draw.choices("abcd", k=draw.randint(6, 12)))
        grams = [word[i : i + 2] for i in range(len(word) - 1)]
        frequency = {g: draw.randint(1, 9) for g in grams}
        places, last = prefix_places(word, frequency)
        assert len(places) >= 3 and places == [i for i, g in enumerate(grams) if (frequency[g], g) <= last]
        options = [p for p in itertools.combinations(places, 2) if p[1] - p[0] >= 2]
        cost = lambda p: sum(frequency[grams[i]] for i in p)
        assert cost(pivots(word, places, frequency)) == min(map(cost, options))


def test_an_edit_changes_at_most_two_bits():
    draw = random.Random(3)
    for _ in range(200):
        word = "".join(draw.choices("abcÉÿ", k=8))
        at = draw.randrange(8)
        for other in (word[:at] + word[at + 1 :], word[:at] + "z" + word[at:], word[:at] + "z" + word[at + 1 :]):
            assert ((letters(word) ^ letters(other)) & (2**64 - 1)).bit_count() <= 2

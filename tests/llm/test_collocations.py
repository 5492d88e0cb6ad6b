"""Collocations against brute force on small tables, and stripes on awkward texts."""

import collections
import random
import re

import numpy as np
import pytest
from conftest import REPEATED, ROWS

from outlay.llm import word_stripes
from outlay.llm.bit_filter import BITS
from outlay.llm.collocations import collocations
from outlay.llm.word_stripes import Stripes, tokens


def plain(rows, least, per_language):
    """(lang, text) -> rows of the report, phrase by phrase."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                f.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    found = collections.defaultdict(list)
    frequent = {p: c for p, c in f.items() if c >= least and len(p) > 2}
    for (lang, *words), a in frequent.items():
        longer = [q for q in frequent if q[0] == lang and len(q) - 1 > len(words) and 100 * frequent[q] >= 100 * a]
        m = len(words)
        if any(list(q[i : i + m]) == words for q in longer for i in range(1, len(q) - m + 1)):
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, m)]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])]))
    report = []
    for lang, phrases in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:per_language], 1):
            report.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(report)


def sample(seed, count):
    draw = random.Random(seed)
    words = ["a", "b", "C", "dd", "É", "the", "漢字", "x-y", "\x00z"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]
    texts = ["".join(draw.choice(words[: draw.randint(2, 9)]) + draw.choice(ends) for _ in range(draw.randint(0, 60))) for _ in range(count)]
    return [(draw.choice(["en", "de", None]), text) for text in texts]


@pytest.mark.parametrize("least, per_language, at_once", [(20, 2000, 2_000_000), (5, 40, 50)])
def test_collocations(spark, monkeypatch, least, per_language, at_once):
    monkeypatch.setattr(word_stripes, "WORDS_AT_ONCE", at_once)
    rows = sample(3, 150) + [("en", "New York Times"), ("en", None), ("und", "b b b b b b b b")] + [("en", "one passage of six words here.")] * 30
    docs = spark.createDataFrame([(lang, text, "x") for lang, text in rows], "lang string, text string, phrase string")
    found = sorted(tuple(r) for r in collocations(docs, least, per_language).collect())
    assert found == plain(rows, least, per_language) and len(found) > 30


def test_awkward_rows(make, empty):
    rows = ROWS + REPEATED
    langs = ("en", "de", None)
    short = [(i, text) for i, text in rows if len(text or "") < 5000]
    docs = make(short)
    expected = plain([(langs[k % 3], text) for k, (_, text) in enumerate(short)], 3, 2000)
    assert sorted(tuple(r) for r in collocations(docs, 3).collect()) == expected
    assert collocations(empty).count() == 0


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_slices_cut_no_word(monkeypatch, size):
    monkeypatch.setattr(word_stripes, "SLICE_BYTES", size)
    for _, text in sample(4, 30) + [(None, "x" * 50), (None, ""), (None, " . "), (None, "a\tB.c")]:
        low = re.sub("[A-Z]+", lambda m: m.group().lower(), text)
        expected = re.sub(r"[.,;:!?\x0A-\x0D]", " \xff ", low)
        got = [word for part in tokens(text) for word in part]
        assert got == [b"\xff" if w == "\xff" else w.encode() for w in re.findall(r"[^\x20\x09]+", expected)]


def test_stripes_add_up():
    texts = ["a b a b c. a b", "b a", ""]
    stripes = Stripes("en", 1, None, word_stripes.Hot([word_stripes.gram_hashes(np.array([word_stripes.word_hash(b"a", "en")], np.uint64), 1)[0]], [4], 9))
    for text in texts:
        stripes.add(text)
    found = collections.defaultdict(dict)
    for batch in stripes.flush():
        for row in batch.to_pylist():
            assert row["lang"] == "en" and (0 <= row["part"] < 4096 if row["prefix"] == "a" else row["part"] == 0)
            found[row["prefix"]].update(zip(row["next"], row["n"]))
    assert found == {"a": {"b": 3, "": 1}, "b": {"a": 2, "c": 1, "": 1}, "c": {"": 1}}
    assert list(stripes.flush()) == []


def test_stripes_without_ends_hold_only_words_that_may_be_frequent():
    bigrams = [word_stripes.gram_hashes(np.array([word_stripes.word_hash(w, "en") for w in pair], np.uint64), 2)[0] for pair in ((b"a", b"b"), (b"b", b"c"))]
    field = np.zeros(BITS // 8, dtype=np.uint8)
    for value in bigrams:
        bit = int(value) % BITS
        field[bit >> 3] |= 1 << (bit & 7)
    found = {}
    for ends in (True, False):
        stripes = Stripes("en", 2, field, ends=ends)
        for text in ("a b c a b. b c", "a b x", "b c b c"):
            stripes.add(text)
        found[ends] = {row["prefix"]: dict(zip(row["next"], row["n"])) for batch in stripes.flush() for row in batch.to_pylist()}
    assert found[True] == {"a b": {"c": 1, "": 2}, "b c": {"": 4}}
    assert found[False] == {"a b": {"c": 1}}

"""Byte-level BPE and token counts against the public library and brute force."""

import random

import brute
import public_tokenizers
import pytest
import tiktoken
from conftest import REPEATED, ROWS

from outlay.llm.byte_bpe import ByteBpe, load_ranks
from outlay.llm.byte_bpe_frames import VOCABULARY, encode_digests, round_trip
from outlay.llm.token_counts import token_counts
from outlay.llm.token_trie import TokenTrie, rank_scores

ALPHABETS = ["ab", "aeiou thn", "abcdefghijklmnopqrstuvwxyz", "éèàüß ñ", "01 234", "!?. \n\t", "漢字かな😀 x"]


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(VOCABULARY)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library(ranks, library):
    bpe, draw = ByteBpe(ranks, public_tokenizers.PATTERN), random.Random(1)
    texts = ["a" * 20_000, "thequick" * 2000, " " * 3000, "\n" * 500, "ab" * 3000]
    texts += ["".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(0, 300))) for _ in range(600)]
    for text in texts:
        ids = bpe.encode(text)
        assert ids == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_joining_is_associative(ranks):
    bpe, draw = ByteBpe(ranks, public_tokenizers.PATTERN), random.Random(2)
    for _ in range(200):
        data = "".join(draw.choices("thequickbrown", k=60)).encode()
        a, b = sorted(draw.sample(range(61), 2))
        parts = [bpe._tree(part) for part in (data[:a], data[a:b], data[b:]) if part]
        left = right = []
        for part in parts:
            left = bpe.join(left, part)
        for part in reversed(parts):
            right = bpe.join(part, right)
        assert left == right == bpe._tree(data)


def test_digests(repeated, empty, library):
    rows = ROWS + REPEATED
    expected = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text or "")))
    assert sorted((tuple(r) for r in encode_digests(repeated).collect()), key=str) == sorted(expected, key=str)
    assert encode_digests(empty).count() == 0


def test_round_trip_keeps_columns(repeated, empty, library):
    coded = round_trip(repeated)
    assert coded.columns == [*repeated.columns, "token_ids", "n_tokens"]
    assert sorted((r.doc_id or 0, r.text or "") for r in coded.collect()) == sorted((i or 0, t or "") for i, t in ROWS + REPEATED)
    assert all(r.token_ids == library.encode_ordinary(r.text or "") and r.n_tokens == len(r.token_ids) for r in coded.collect())
    assert sum(r.text is None for r in coded.collect()) == 2
    assert round_trip(coded).columns == coded.columns
    assert round_trip(empty).count() == 0


def test_trie_equals_single_segmentation(ranks):
    scores = rank_scores(ranks)
    trie, draw = TokenTrie(scores), random.Random(3)
    words = ["".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(1, 14))) for _ in range(500)]
    assert [trie[w] for w in words + words] == [brute.unigram_count(w.encode(), scores) for w in words + words]
    with pytest.raises(ValueError):
        TokenTrie({b"a": -1.0})


def test_equal_scores_take_fewer_tokens():
    scores = {bytes([b]): -1.0 for b in range(256)} | {b"ab": -2.0}
    assert TokenTrie(scores)["ab"] == 1 and TokenTrie(scores)["ba"] == 2


def test_token_counts(repeated, empty, ranks, library, monkeypatch):
    import regex

    scores, split = rank_scores(ranks), regex.compile(public_tokenizers.PATTERN).findall
    short = [(i, t) for i, t in ROWS + REPEATED if len(t or "") < 3500]
    expected = sorted((i or -1, len(split(t or "")), sum(brute.unigram_count(p.encode(), scores) for p in split(t or ""))) for i, t in short)
    found = [(r.doc_id or -1, r.n_pretokens, r.n_tokens) for r in token_counts(repeated).collect()]
    assert len(found) == len(ROWS + REPEATED)
    assert sorted(row for row in found if row[0] not in (8, 9)) == expected
    assert token_counts(empty).count() == 0

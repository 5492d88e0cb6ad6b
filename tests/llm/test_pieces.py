"""Piece encoding by distinct chunks against the public library."""

import random

import brute
import numpy as np
import pytest
import sentencepiece
from conftest import REPEATED, ROWS

from outlay.llm import piece_chunks
from outlay.llm.piece_chunks import ChunkTable, Segmenter, chunks, free_signs, load_vocabulary, unmarked
from outlay.llm.sentence_pieces import MODEL, encode_piece_digests, encode_pieces

ALPHABETS = ["ab", "aeiou thn", "abcdefghijklmnopqrstuvwxyz ", "éèàüß ñ", "01 234", "!?. \n\t", "漢字かな😀 x", "▁ ab", "<s>/0xA ", "\x00ab "]
MORE = [(100, "▁▁ marked▁word "), (101, "   "), (102, "<s> </s> <0x0A>"), (103, "x" * 5000), (104, "😀" * 400), (105, " lead and trail  "), (106, "\x00 a")]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def segmenter():
    return Segmenter(load_vocabulary(MODEL))


def test_chunks_equal_the_library(segmenter, library):
    draw = random.Random(5)
    texts = ["".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(0, 200))) for _ in range(1500)]
    texts += ["the quick  brown\n\nfox " * 300, "a" * 3000, " " * 300, ""]
    for text in texts:
        found = [segmenter.encode_chunk(chunk) for chunk in chunks(text, segmenter.vocabulary.chunk_pattern())]
        ids = [i for part in found for i in part]
        assert ids == library.encode(text)
        assert unmarked("".join(map(segmenter.decode_marked, found))) == library.decode(ids)
        assert unmarked(segmenter.decode_marked([1, *ids, 2])) == library.decode([1, *ids, 2])


def test_long_and_short_merging_agree(segmenter, monkeypatch):
    draw = random.Random(6)
    words = ["▁" + "".join(draw.choices("thequickbrown", k=draw.randint(1, 60))) for _ in range(300)]
    short = [segmenter.encode_chunk(word) for word in words]
    monkeypatch.setattr(piece_chunks, "SHORT", 0)
    assert short == [segmenter.encode_chunk(word) for word in words]


def test_the_table_forgets_without_changing_values(segmenter):
    table = ChunkTable(segmenter, {"▁a": (b"shared", "▁a")}, 1000)
    first = [table[c] for c in ("▁b", "▁c", "▁word", "▁" + "x" * 999)]
    assert len(table) == 4 and table["▁a"] == (b"shared", "▁a")
    for _ in range(3):
        table.turn()
        assert [table[c] for c in ("▁b", "▁c", "▁word", "▁" + "x" * 999)] == first
    table.used = 10**6
    table.turn()
    assert dict(table) == table.shared and table.used == 0


@pytest.mark.parametrize("rows", [100_000, 3, 0])
def test_digests(make, empty, library, rows):
    data = ROWS + REPEATED + MORE
    expected = []
    for doc_id, text in data:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        expected.append((doc_id, len(ids), brute.sha(np.asarray(ids, "<u4").tobytes()), brute.sha(library.decode(ids))))
    found = [tuple(r) for r in encode_piece_digests(make(data), rows=rows).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert encode_piece_digests(empty, rows=rows).count() == 0


def test_ids_and_texts(repeated, library):
    found = {(r.doc_id, r.decoded): list(r.ids) for r in encode_pieces(repeated).collect()}
    assert found == {(i, t or ""): library.encode(t or "", add_bos=True, add_eos=True) for i, t in ROWS + REPEATED}


def test_signs_that_stand_alone():
    free, alone = free_signs(["▁the", "ab", "!!", "#-", "a1", "e;", "▁.", ".”"])
    assert set("!#-,.\n") <= set(free) and ";" not in free
    assert set(",\n") <= set(alone) and not set("!#-;") & set(alone)


def test_a_model_whose_pieces_cross_markers_is_refused(monkeypatch):
    class Crossing(sentencepiece.SentencePieceProcessor):
        def id_to_piece(self, i):
            return "a▁b" if i == 300 else super().id_to_piece(i)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError):
        load_vocabulary(MODEL)

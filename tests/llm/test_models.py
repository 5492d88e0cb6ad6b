"""Learned operators: language, quality, toxicity, personal data. Held-out accuracy, gradients, awkward rows."""

import itertools
import random
import time
import zlib

import brute
import numpy as np
import pytest
from conftest import REPEATED, ROWS, prose
from pyspark.sql import functions as F

from outlay.llm import language_ecoc, personal_data, quality_crf, toxicity_gru
from outlay.llm.boosted_trees import Boosted, Leaf, Split, boost, calibrated_threshold
from outlay.llm.labelled import smallest_hashes

TONGUES = {
    "aa": "kala mora tiva suna leko para".split(),
    "bb": "strom grad welk brint fluss kern".split(),
    "cc": "oui jeva cela dont près où".split(),
}


def sentences(seed, tongue, words):
    draw = random.Random(seed)
    return " ".join(draw.choice(TONGUES[tongue]) + draw.choice(TONGUES[tongue])[:3] for _ in range(words))


# Language


@pytest.mark.parametrize("count", range(0, 12))
def test_codewords_are_distinct(count):
    code = language_ecoc.codewords(count)
    assert len({tuple(row) for row in code}) == len(code) == count or count < 2
    assert all(len(set(column)) == 2 for column in code.T)


def test_language_of_held_out_documents(make):
    names = sorted(TONGUES)
    rows = [(i, sentences(i, names[i % 3], 5 + i % 40)) for i in range(240)]
    docs = make(rows, langs=names)
    found = language_ecoc.identify(docs, language_ecoc.train(docs)).collect()
    assert len(found) == 240
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred == names[r.doc_id % 3] and 0 <= r.score <= 1


def test_language_of_a_mixture_is_ambiguous(make):
    names = sorted(TONGUES)
    docs = make([(i, sentences(i, names[i % 3], 40)) for i in range(90)], langs=names)
    model = language_ecoc.train(docs)
    mixed = make([(1000, sentences(1, "aa", 30) + " " + sentences(2, "bb", 30)), (1001, sentences(3, "aa", 60))])
    found = {r.doc_id: r for r in language_ecoc.identify(mixed, model).collect()}
    assert found[1000].score < found[1001].score


def test_language_of_awkward_rows(repeated, empty, make):
    model = language_ecoc.train(repeated)
    found = language_ecoc.identify(repeated, model).collect()
    assert len(found) == len(ROWS + REPEATED)
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in found} <= {"und", *model.languages}
    assert language_ecoc.identify(empty, model).count() == 0
    nothing = language_ecoc.train(empty)
    assert {r.lang_pred for r in language_ecoc.identify(repeated, nothing).collect()} == {"und"}
    one = language_ecoc.train(make([(i, "some words") for i in range(9)], langs=("xx",)))
    assert {r.lang_pred for r in language_ecoc.identify(repeated, one).collect()} == {"und", "xx"}


# Quality


def test_forward_backward_equals_enumeration():
    draw = np.random.default_rng(0)
    pairs = draw.normal(size=(2, 2))
    lengths = np.array([1, 4, 3])
    scores = draw.normal(size=8)
    good, counts = quality_crf.marginals(scores, lengths, pairs)
    begin, expected_counts = 0, np.zeros((2, 2))
    for n in lengths:
        s, total, mass = scores[begin : begin + n], 0.0, np.zeros(n)
        edge = np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum((1 if y else -1) * x / 2 for y, x in zip(states, s)) + sum(pairs[a, b] for a, b in zip(states, states[1:])))
            total += w
            mass += w * np.array(states)
            for a, b in zip(states, states[1:]):
                edge[a, b] += w
        assert np.allclose(good[begin : begin + n], mass / total)
        expected_counts += edge / total
        begin += n
    assert np.allclose(counts, expected_counts)


def test_quality_of_held_out_documents(make, spark):
    rows = []
    for i in range(150):
        good = "\n".join(prose(i * 7 + k, 12).capitalize() + "." for k in range(3))
        bad = "\n".join("BUY!! NOW!! " * 6 if k % 2 else "click | here | click | here" for k in range(4))
        rows.append((i, bad if i % 4 == 0 else good))
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(150)], "doc_id long, quality int, toxic int")
    docs = make(rows)
    found = quality_crf.quality_scores(docs, quality_crf.train(docs, labels)).collect()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.doc_id % 4 != 0) == int(r.score >= 0.3)
    kept = quality_crf.drop_rejected(docs, quality_crf.train(docs, labels))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in range(150) if i % 4}


def test_quality_of_awkward_rows(repeated, empty, labels):
    for sample in (labels, labels.limit(0)):
        model = quality_crf.train(repeated, sample)
        found = quality_crf.quality_scores(repeated, model).collect()
        assert len(found) == len(ROWS + REPEATED) and all(0 <= r.score <= 1 for r in found)
        by_text = {}
        for r in found:
            by_text.setdefault(dict(ROWS).get(r.doc_id) if r.doc_id != 5 else None, set()).add(round(r.score, 9))
        assert quality_crf.quality_scores(empty, model).count() == 0
    assert quality_crf.train(empty, labels).slope == 0.0


# Toxicity


def test_gradient_of_the_network_equals_differences():
    draw = np.random.default_rng(1)
    network = toxicity_gru.Network({k: v.astype(np.float64) for k, v in toxicity_gru.Network.start().p.items()})
    inputs = draw.normal(size=(5, 4, toxicity_gru.INPUTS))
    there = np.ones((5, 4), dtype=bool)
    there[3:, 1] = False
    truth, weight = np.array([1.0, 0, 1, 0]), np.array([0.3, 0.2, 0.4, 0.1])

    def likelihood(p):
        net = toxicity_gru.Network(p)
        states = np.concatenate([net._read(w, inputs @ p[f"{w}x"], False)[0] for w in ("f", "b")], axis=2)
        odds = net._pool(states, there)[0] @ p["out"] + p["bias"]
        return (weight * (truth * odds - np.log1p(np.exp(odds)))).sum()

    grad = network.gradient(inputs, there, truth, weight)
    for name, value in network.p.items():
        at = tuple(draw.integers(0, n) for n in value.shape)
        step = np.zeros_like(value)
        step[at] = 1e-2
        up, down = ({**network.p, name: value + sign * step} for sign in (1, -1))
        assert abs((likelihood(up) - likelihood(down)) / 2e-2 - np.asarray(grad[name])[at]) < 2e-3


def test_windows_overlap_and_cover_all_words():
    table = toxicity_gru.WordTable(toxicity_gru.Evidence(pieces={b"los": (1.0, 9)}))
    for n in (0, 1, 24, 25, 44, 45, 100):
        windows = table.windows([b"loser%d" % i for i in range(n)])
        seen = [row for row in windows.tolist()]
        assert {x for row in seen for x in row if x} == {table[b"loser%d" % i] for i in range(n)}
        assert len(seen) == 1 if n <= 24 else all(a[20:] == b[:4] for a, b in zip(seen, seen[1:]))


def test_a_passage_of_half_a_window_and_more_lies_whole_in_a_window():
    table = toxicity_gru.WordTable(toxicity_gru.Evidence(pieces={b"los": (1.0, 9)}))
    for n in (12, 25, 34, 35, 44, 45, 100):
        words = [b"loser%d" % i for i in range(n)]
        windows = table.all_windows(words).tolist()
        ids = [table[word] for word in words]
        for at in range(n - min(n, 15) + 1):
            passage = ids[at : at + 15]
            assert any(row[k : k + len(passage)] == passage for row in windows for k in range(25 - len(passage)))


def test_equal_windows_are_scored_once_and_alike(monkeypatch):
    table = toxicity_gru.WordTable(toxicity_gru.Evidence(pieces={b"los": (1.0, 9)}))
    texts = ["abc " * 400, "loser " + "abc " * 60, "abc " * 24, ""]
    network, scored = toxicity_gru.Network.start(), []
    windows = [table.all_windows(toxicity_gru.words_of(text)) for text in texts]
    alone = [network.log_odds(table.rows, some).max() for some in windows]
    real = network.log_odds
    monkeypatch.setattr(network, "log_odds", lambda rows, windows: scored.append(len(windows)) or real(rows, windows))
    assert np.allclose(toxicity_gru._highest(texts, table, network), alone, atol=1e-5)
    assert sum(scored) < 12 < len(windows[0])


def test_long_words_are_read_to_their_end():
    table = toxicity_gru.WordTable(toxicity_gru.Evidence({b"w" * 200: (2.0, 9)}, {b"xyz": (1.0, 9), b"ab$": (3.0, 9)}))

    def described(*words):
        windows = table.windows(list(words))
        return table.rows[windows]

    for n in (0, 20, 57, 58, 59, 60, 61, 62, 116, 117, 118, 300, 5000):
        assert described(b"q", b"-" * 70 + b"m" * n + b"xyzm", b"q")[:, :, 2].max() == 0.5
        framed = toxicity_gru.framed_word(b"0123456789ab" * (n // 12) + b"0" * (n % 12))
        parts = toxicity_gru.stretches(framed)
        for size in toxicity_gru.PIECE_SIZES:
            pieces = {framed[i : i + size] for i in range(len(framed) - size + 1)}
            assert pieces == {part[i : i + size] for part in parts for i in range(len(part) - size + 1)}
        assert pieces <= set(toxicity_gru.pieces_of(framed[1:-1]))
    # No end mark inside a word, and the word as a whole is known in each of its stretches.
    assert described(b"m" * 58 + b"ab" + b"m" * 30)[:, :, 2].max() == 0
    assert described(b"m" * 300 + b"ab")[:, :, 2].max() == 1.5
    assert (described(b"w" * 200)[0, :4, 0] == 1.0).all()


def test_toxicity_of_held_out_documents(make, spark):
    rows = []
    for i in range(400):
        words = prose(i, 60 + i % 90).split()
        if i % 3 == 0:
            for k in range(2):
                words[(i * 7 + k * 31) % len(words)] = random.Random(i + k).choice(["dreck", "lump", "dreckig", "lumpen"])
        rows.append((i, " ".join(words)))
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    docs = make(rows)
    found = toxicity_gru.toxicity_scores(docs, toxicity_gru.train(docs, labels)).collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in held]) > 0.95


def test_toxicity_of_awkward_rows(repeated, empty, labels):
    for sample in (labels, labels.limit(0)):
        model = toxicity_gru.train(repeated, sample)
        found = toxicity_gru.toxicity_scores(repeated, model).collect()
        assert len(found) == len(ROWS + REPEATED) and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1
        assert toxicity_gru.toxicity_scores(empty, model).count() == 0


# Personal data

PARTS = [
    "a@b.c", "x.y@z-1.com", "@", ".", "1.2.3.4", "255.255.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "+1 (555) 123-4567", "+12",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", " ", "-", "é", "😀", "abc", "12", "a@b",
    "%_x@y.z.w@q.r", "0", "00", "+49(0)30.1234567", "\n", "john (at) example (dot) com", "5500 0000 0000 0004",
]


def test_base_spans(make):
    draw = random.Random(3)
    rows = [(i, "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 25)))) for i in range(600)] + [(i + 1000, t) for i, t in ROWS]
    docs = make(rows)
    model = personal_data.train(docs)
    found = {r.doc_id: r for r in personal_data.personal_data(docs, model).collect()}
    for i, text in rows:
        spans = brute.base_spans(text or "")
        r = found[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        named = [f"{brute.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == brute.sha(",".join(named))
        assert set(named) <= set(r.spans.split(",")) and r.n_added == len([s for s in r.spans.split(",") if s]) - len(named)


def test_personal_data_of_awkward_rows(repeated, empty):
    model = personal_data.train(repeated)
    assert personal_data.personal_data(repeated, model).count() == len(ROWS + REPEATED)
    nothing = personal_data.train(empty)
    assert personal_data.personal_data(empty, nothing).count() == 0
    assert {r.n_added for r in personal_data.personal_data(repeated, nothing).collect()} == {0}


def test_very_long_runs_are_matched_in_linear_time(make):
    rows = [(1, "a" * 300_000), (2, "1" * 300_000), (3, "1.2" * 3000 + "@" + "b." * 20_000 + "c"), (4, "1 " * 50_000)]
    docs = make(rows)
    found = {r.doc_id: r for r in personal_data.personal_data(docs, personal_data.train(docs)).collect()}
    assert [found[i].n_email for i in (1, 2, 3, 4)] == [0, 0, 1, 0]


def test_trees_as_columns_equal_trees(spark):

    draw = np.random.default_rng(5)
    rows = draw.integers(0, 4, (60, 3))
    positive = ((rows[:, 0] > 1) ^ (rows[:, 2] > 2)).astype(float) * 5
    model = boost(rows, positive, 5 - positive)
    frame = spark.createDataFrame([tuple(map(int, row)) for row in rows], "f0 int, f1 int, f2 int")
    found = [r.score for r in frame.select(model.column(lambda f: F.col(f"f{f}")).alias("score")).collect()]
    assert np.allclose(found, model.log_odds(rows))
    assert ((model.log_odds(rows) > 0) == (positive > 0)).all()


def test_threshold_reaches_the_precision():
    odds = np.array([3.0, 2.0, 2.0, 1.0, 0.0])
    positive, negative = np.array([5.0, 5, 0, 9, 1]), np.array([0.0, 0, 1, 0, 9])
    assert calibrated_threshold(odds, positive, negative, 0.9) == 1.0
    assert calibrated_threshold(odds, positive, negative, 1.0) == 3.0
    assert calibrated_threshold(odds[:0], positive[:0], negative[:0], 0.9) == float("inf")
    assert Boosted(0.5, [Split(0, 1, Leaf(1.0), Leaf(-1.0))]).log_odds(np.array([[0], [2]])).tolist() == [1.5, -0.5]


@pytest.mark.parametrize("per_value", [1, 30, 10_000])
def test_the_sample_is_the_ids_of_smallest_hash(spark, per_value):
    ids = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("lang"))
    ids = ids.unionByName(spark.createDataFrame([(None, "none")], "doc_id long, lang string"))
    found = {(r.doc_id, r.lang) for r in smallest_hashes(ids, "lang", per_value).collect()}
    rows = sorted((r[0], r[1], r[2]) for r in ids.where("doc_id IS NOT NULL").select(F.xxhash64("doc_id"), "doc_id", "lang").collect())
    expected = {(i, lang) for value in ("rare", "hot") for _, i, lang in [row for row in rows if row[2] == value][:per_value]}
    assert found - {(None, "none")} == expected
    assert smallest_hashes(ids.limit(0), "lang", per_value).count() == 0


def test_a_text_with_very_many_matches(make):
    text = " ".join(f"n{i}@host.org 10.0.{i % 250}.1" for i in range(20_000))
    docs = make([(1, text), (2, "clean"), (3, "a@b.cd")])
    begin = time.monotonic()
    found = {r.doc_id: r for r in personal_data.personal_data(docs, personal_data.train(docs)).collect()}
    assert time.monotonic() - begin < 240
    spans = brute.base_spans(text)
    named = [f"{brute.KINDS[k]}:{a}:{b}" for a, k, b in spans]
    assert (found[1].n_email, found[1].n_ip) == (20_000, 20_000) and found[1].base_sha256 == brute.sha(",".join(named))
    assert set(named) <= set(found[1].spans.split(","))

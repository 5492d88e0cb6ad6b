"""Exact, near-duplicate and substring removal against brute force, with awkward rows."""

import random

import brute
import numpy as np
import pytest
from conftest import COPY, REPEATED, ROWS, prose

from outlay.llm import exact_dedup, minhash_dedup, suffix_dedup
from outlay.llm.bit_filter import passes
from outlay.llm.common import WorkTables
from outlay.llm.components import components
from outlay.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from outlay.llm.minhash_dedup import drop_near_duplicates, near_duplicates
from outlay.llm.shingles import hash_functions, minima
from outlay.llm.suffix_dedup import removal_digests


def edited(seed, count):
    """Base texts, copies, copies with few and many changed words, and passages in other texts."""
    draw = random.Random(seed)
    bases = [prose(100 + k, draw.randint(3, 150)) for k in range(count // 6)]
    rows = []
    for i in range(count):
        words = draw.choice(bases).split()
        for _ in range(draw.choice([0, 0, 1, 2, 5, 12])):
            words[draw.randrange(len(words))] = "edit" + str(draw.randrange(50))
        if draw.random() < 0.3:
            words = prose(i, 30).split() + words[: draw.randint(1, len(words))] + prose(i + 7, 9).split()
        rows.append((i, " ".join(words)))
    return rows


def test_exact_duplicates(repeated):
    rows = ROWS + REPEATED
    found = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in exact_duplicates(repeated).collect()]
    assert sorted(found, key=str) == sorted(brute.exact(rows), key=str)
    kept = [r for r in exact_duplicates(repeated).collect() if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({row[3] for row in brute.exact(rows)})


def test_exact_duplicates_with_small_blocks_and_a_collision(make, monkeypatch):
    rows = edited(3, 60)
    seeds = []
    real = exact_dedup._collisions
    monkeypatch.setattr(exact_dedup, "_collisions", lambda *a: seeds.append(a[-1]) or len(seeds) < 2 or real(*a))
    found = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in exact_duplicates(make(rows), 7).collect()]
    assert sorted(found) == sorted(brute.exact(rows)) and seeds == [1, 2]


def test_equal_fingerprints_of_different_blocks_are_seen(make, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "_fingerprint", lambda block, seed: F.struct(F.lit(0).alias("h1"), F.lit(0).alias("h2")))
    assert exact_dedup._collisions(make([(1, "a"), (2, "b")]), 8, 1)
    assert not exact_dedup._collisions(make([(1, "a"), (2, "a")]), 8, 1)


def test_exact_stage_keeps_one_row_of_each_text(repeated, empty):
    kept = drop_exact_duplicates(repeated)
    assert kept.columns == repeated.columns
    texts = [row[3] for row in brute.exact([(r.doc_id, r.text) for r in kept.collect()])]
    assert len(texts) == len(set(texts)) == len({row[3] for row in brute.exact(ROWS + REPEATED)})
    assert drop_exact_duplicates(empty).count() == 0


@pytest.mark.parametrize("small", [64, 1])
def test_near_duplicates(awkward, make, monkeypatch, small):
    monkeypatch.setattr(minhash_dedup, "SMALL_BUCKET", small)
    for rows in (ROWS, edited(5, 120)):
        found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(make(rows)).collect()}
        assert found == {i: (n, root, root == i) for i, (n, root) in brute.components(rows).items()}


def test_near_duplicates_of_repeated_rows(repeated, empty):
    rows = near_duplicates(repeated).collect()
    assert len(rows) == len(ROWS + REPEATED)
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert {r.component_id for r in rows if r.doc_id in (5, 6, 7, 13)} == {5}
    kept = drop_near_duplicates(repeated)
    assert kept.columns == repeated.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 3, 4, 5, None}
    assert not {r.doc_id for r in kept.collect()} & {6, 7, 13}
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


def test_rows_that_share_a_doc_id(make):
    x, y, z = prose(21, 60), prose(22, 60), prose(23, 60)
    rows = [(3, x), (5, x), (5, y), (7, y + " more"), (8, z), (5, z), (9, None), (9, "")]
    for order in (rows, rows[::-1]):
        found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_duplicates(make(order)).collect()}
        assert {found[key][0] for key in found if key[0] != 9} == {3} and found[(9, 0)] == (9, True)
        kept = sorted((r.doc_id, r.text or "") for r in drop_near_duplicates(make(order)).collect())
        assert kept == sorted([(3, x), (5, y), (5, z), (9, ""), (9, "")])


def test_disjoint_long_texts_share_no_band():
    draw = np.random.Generator(np.random.PCG64(7))
    sets = [np.unique(draw.integers(0, 2**64, 200_000, dtype=np.uint64)) for _ in range(2)]
    a, b = minima(sets, hash_functions(minhash_dedup.BANDS * minhash_dedup.ROWS_PER_BAND))
    assert (a == b).sum() <= 2 and not (a.view(np.int64) == b.view(np.int64)).any()


def test_agreeing_minima_are_counted_in_columns(spark):
    draw = np.random.Generator(np.random.PCG64(8))
    a = draw.integers(0, 2**16, (20, 160), dtype=np.uint16)
    b = np.where(draw.random((20, 160)) < 0.6, a, draw.integers(0, 2**16, (20, 160), dtype=np.uint16))
    rows = [(x.view(np.int64).tolist(), y.view(np.int64).tolist()) for x, y in zip(a, b)]
    table = spark.createDataFrame(rows, "a array<long>, b array<long>")
    found = [r[0] for r in table.select(minhash_dedup._agreeing(table["a"], table["b"])).collect()]
    assert found == (a == b).sum(axis=1).tolist()


def test_a_dropped_table_is_empty(spark):
    work = WorkTables(spark, "test")
    table, other = work.keep(spark.range(5), "a"), work.keep(spark.range(6), "b")
    path = table.inputFiles()[0].rsplit("/", 1)[0]
    work.drop(table)
    assert spark.read.parquet(path).count() == 0 and other.count() == 6


@pytest.mark.parametrize("at_once", [2_000_000, 30])
def test_shingles_of_a_group_are_handed_on_once_a_task(spark, monkeypatch, at_once):
    """Members of a group share shingles; a task's rows are its distinct shingles, not members times shingles."""
    monkeypatch.setattr(minhash_dedup, "_SHINGLES_AT_ONCE", at_once)
    rows = [(node, [*range(-20, 20), 1000 + node]) for node in range(600)] + [(3, [7, 5000]), (9, []), (9, [6000]), (8, [6000])]
    sets = spark.createDataFrame(rows, "node long, shingles array<long>").coalesce(1)
    found = [tuple(r) for r in minhash_dedup._held(sets).collect()]
    holders = {}
    for node, shingles in rows:
        for shingle in shingles:
            holders.setdefault(shingle, set()).add(node)
    merged = {}
    for shingle, low, high in found:
        before = merged.get(shingle, (low, high))
        merged[shingle] = min(low, before[0]), max(high, before[1])
    assert merged == {shingle: (min(nodes), max(nodes)) for shingle, nodes in holders.items()}
    if at_once > 600 * 41:
        assert len(found) == len(holders)
    field = minhash_dedup._found_elsewhere(sets)
    shared = np.array([shingle for shingle, nodes in holders.items() if len(nodes) > 1])
    assert passes(field, shared).all() and not passes(field, np.arange(1000, 1600)).any()
    assert not minhash_dedup._found_elsewhere(sets.where("node < 0")).any()


def test_a_pair_leaves_one_of_its_large_buckets(spark):
    sets = [(1, list(range(100))), (2, [*range(99), 200]), (3, [*range(98), 300, 301])]
    placed = [(key, node, node, 1, 100, [0]) for key in (10, 20, 30) for node, _ in sets if (key, node) != (10, 3)]
    rows = minhash_dedup._remaining_in_large(
        WorkTables(spark, "test"),
        spark.createDataFrame(placed, "key long, node long, root long, largest long, n long, bands array<long>"),
        spark.createDataFrame(sets, "node long, shingles array<long>"),
    )
    assert sorted((r.a, r.b) for r in rows.collect()) == [(1, 2), (1, 3), (2, 3)]


def test_a_chain_whose_ends_are_not_similar_is_one_component(make):
    words = prose(9, 100).split()
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        words = words[2:] + [f"new{i}a", f"new{i}b"]
    assert len({root for _, root in brute.components(rows).values()}) == 1
    assert {r.component_id for r in near_duplicates(make(rows)).collect()} == {0}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 29), (60, 61)]])
def test_components(spark, edges):
    links = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(WorkTables(spark, "test"), links).collect()}
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {n: r for n, r in root.items() if n != r}


@pytest.mark.parametrize("hot", [20_000, 1])
def test_removed_strings(make, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_CORE", hot)
    draw = random.Random(4)
    rows = edited(8, 60) + [(1000 + i, "ab" * draw.randint(50, 400) + prose(i, 20)) for i in range(6)]
    rows += [(2000, "x" * 199), (2001, "x" * 199), (2002, "y" * 200), (2003, "z" * 201), (2004, None), (2005, "")]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in removal_digests(make(rows)).collect()}
    assert found == dict(zip([i for i, _ in rows], brute.removed([text for _, text in rows])))


def test_contexts_of_identical_copies_are_given_once_a_task(make, monkeypatch):
    near = COPY[:500] + "changed" + COPY[500:]
    rows = [(i, COPY) for i in range(200)] + [(900, near)]
    given, real = [], suffix_dedup._contexts
    monkeypatch.setattr(suffix_dedup, "_contexts", lambda *a: given.append(real(*a)) or given[-1])
    found = {tuple(r) for r in removal_digests(make(rows).coalesce(1)).collect()}
    assert found == {(i, *row) for (i, _), row in zip(rows, brute.removed([text for _, text in rows]))}
    assert 0 < given[0].count() < 60


def test_removed_strings_of_awkward_rows(repeated, empty):
    rows = ROWS + REPEATED
    found = sorted(tuple(r) for r in removal_digests(repeated).na.fill(-1, ["doc_id"]).collect())
    expected = [(-1 if i is None else i, *row) for (i, _), row in zip(rows, brute.removed([text for _, text in rows]))]
    assert found == sorted(expected)
    assert removal_digests(empty).count() == 0
    assert len(COPY) > 200

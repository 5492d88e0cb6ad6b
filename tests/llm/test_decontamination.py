"""Benchmark decontamination and the whole pipeline."""

import random

import brute
import pytest
from compare import TEST_DATA, differences, duck
from conftest import REPEATED, ROWS, prose

import __spark_entry__ as entry_points
import corpus_pipeline
from outlay.llm import decontamination
from outlay.llm.decontamination import contaminated_documents, drop_contaminated


def planted(count):
    draw = random.Random(11)
    items = [(k, prose(500 + k, draw.randint(5, 60))) for k in range(14)] + [(90, prose(501, 30)), (91, prose(501, 30)), (92, None), (93, "")]
    docs = []
    for i in range(count):
        words = prose(i, draw.randint(0, 120)).split()
        if i % 2:
            part = (draw.choice(items[:16])[1]).split()
            for _ in range(draw.choice([0, 0, 1, 3, 8])):
                part[draw.randrange(len(part))] = "other"
            if draw.random() < 0.3:
                part = part[: len(part) // 2]
            words[len(words) // 2 : len(words) // 2] = [w.upper() + "," for w in part] if i % 3 else part
        docs.append((i, " ".join(words)))
    return docs, items


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_contaminated_documents(make, spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_SEEDS", block)
    docs, items = planted(120 if block > 50 else 40)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in contaminated_documents(make(docs), benchmark).collect()]
    assert len(found) == len(set(found)) and set(found) == brute.contaminated(docs, items) and found


def on_one_diagonal(docs, items):
    """(doc_id, item_id) by the rule on any single diagonal, without masks or seeds."""
    words = lambda text: text.lower().split()
    found = set()
    for item_id, item in items:
        q = words(item)
        for doc_id, text in docs:
            d = words(text)
            for diagonal in range(1 - len(q), len(d)):
                equal = [0 <= j + diagonal < len(d) and d[j + diagonal] == q[j] for j in range(len(q))]
                stretch = max(sum(equal[a : a + 20]) for a in range(max(1, len(q) - 19)))
                if 4 * sum(equal) >= 3 * len(q) or stretch >= 15:
                    found.add((doc_id, item_id))
                    break
    return found


def test_no_pattern_of_differing_words_is_missed(make, spark):
    draw = random.Random(12)
    items = [(n, " ".join(f"w{draw.randrange(400)}" for _ in range(n))) for n in (10, 11, 13, 15, 18, 19, 20, 29, 38, 59)]
    docs = []
    for n, item in items:
        for k in range(14):
            words = item.split()
            places = range(k, n, 4) if k < 4 else draw.sample(range(n), n // 4 + (k > 11))
            for at in places:
                words[at] = "other"
            before = [f"w{draw.randrange(400)}" for _ in range(draw.choice([0, 3, 30]))]
            docs.append((n * 100 + k, " ".join(before + words + before[::-1])))
    docs.append((1, " ".join(items[-1][1].split()[20:40][::1][:15] + ["x"] * 5)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in contaminated_documents(make(docs), benchmark).collect()}
    exact, masks = on_one_diagonal(docs, items), brute.contaminated(docs, items)
    assert found == exact | masks and len(exact - masks) > 10


def test_short_unspaced_and_nameless_items(make, spark):
    items = [(1, "What is the capital of France?"), (2, "Sky"), (3, "東京は日本の首都であり、人口が最も多い都市です。"), (None, "who wrote this short line"), (None, prose(77, 30)), (4, "one two three four five six seven eight nine")]
    docs = [
        (1, "q: what IS the capital, of france"), (2, "what is the capital of spain france"), (3, "blue sky here"),
        (4, "前置き。東京は日本の首都であり、人口が最も多い都市です。続き"), (5, "he asked who wrote this short line today"),
        (6, prose(77, 30) + " end"), (7, "one two three four five six seven eight nine"), (8, "one two three four five six seven nine eight"),
        (9, "東京"), (10, ""), (11, None),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(((r.doc_id, r.item_id) for r in contaminated_documents(make(docs), benchmark).collect()), key=str)
    assert found == [(1, 1), (3, 2), (4, 3), (5, None), (6, None), (7, 4)]
    assert {r.doc_id for r in drop_contaminated(make(docs), benchmark).collect()} == {2, 8, 9, 10, 11}


def test_contamination_of_awkward_rows(repeated, empty, spark):
    benchmark = spark.createDataFrame([(1, ROWS[4][1][:300]), (None, ROWS[4][1]), (2, None)], "item_id long, text string")
    found = {r.doc_id for r in contaminated_documents(repeated, benchmark).collect()}
    assert found == {5, 6, 7, 13, None}
    kept = drop_contaminated(repeated, benchmark)
    # The clean texts under doc_id 5 and without doc_id stay.
    assert kept.columns == repeated.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in ROWS} - {6, 7, 13} | {None}
    assert all((r.text or "").lower() != ROWS[4][1].lower() for r in kept.collect())
    for docs, items in ((empty, benchmark), (repeated, benchmark.limit(0))):
        assert contaminated_documents(docs, items).count() == 0
        assert drop_contaminated(docs, items).count() == docs.count()


SF_DIR = f"{TEST_DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(set(entry_points.oracle_sql()) - {n for n in entry_points.queries() if not n.startswith("op")}))
def test_query_matches_sql(spark, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    cursor = duck(SF_DIR).execute(entry_points.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert differences(frame.collect(), frame.columns, cursor.fetchall(), names) is None


def test_pipeline_equals_plain_steps(spark):
    """After the classifier's decision every stage is replayed by brute force."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert 0.5 * docs.count() < len(rows) < docs.count()
    first = {row[1] for row in brute.exact(rows)}
    rows = [row for row in rows if row[0] in first]
    parts = brute.components(rows)
    rows = [row for row in rows if parts[row[0]][1] == row[0]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = {i for i, _ in brute.contaminated(rows, items)}
    expected = {i: text for i, text in rows if i not in found}
    result = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id: r.text for r in result.collect()} == expected
    assert result.columns == [*docs.columns, "token_ids", "n_tokens"]


def test_pipeline_of_empty_and_awkward_tables(spark, repeated, tmp_path):
    for name, rows in (("empty", repeated.limit(0)), ("awkward", repeated)):
        folder = str(tmp_path / name)
        rows.withColumnRenamed("kept", "source").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        found = [r.text for r in corpus_pipeline.run(spark, folder).collect()]
        # Nothing is learned without labels, so nothing is rejected; copies go. One doc_id may stand for two texts.
        assert len(found) == len(set(found)) and (len(found) == 0) == (name == "empty")
    assert len(REPEATED)


def test_texts_of_one_doc_id_are_judged_apart(make, spark):
    item = prose(70, 40)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    half, clean = " ".join(item.split()[:10]) + " " + prose(71, 30), prose(72, 50)
    rows = [(7, half), (7, item), (7, clean), (None, item), (None, clean), (8, None)]
    for order in (rows, rows[::-1]):
        found = {(r.doc_id, r.item_id, r.agreeing_words) for r in contaminated_documents(make(order), items).collect()}
        assert found == {(7, 1, 40), (None, 1, 40)}
        kept = sorted((r.doc_id or 0, r.text or "") for r in drop_contaminated(make(order), items).collect())
        assert kept == sorted([(7, half), (7, clean), (0, clean), (8, "")])

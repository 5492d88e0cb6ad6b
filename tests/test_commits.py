"""The commit log of raw tables: readers, writers, stops half-way, old tables, cleaning."""

import glob
import os
import threading

import pytest
from fixtures import agreement, amendment, documents
from pyspark.sql import functions as F

from outlay.session import run_together
from outlay.sources import raw
from outlay.sources.commits import CommitLog, Part, Snapshot

A = ("2026-07-01", "2026-07-07")
B = ("2026-07-02", "2026-07-08")
T1, T2 = "2026-07-08 06:00:00", "2026-07-09 06:00:00"


def load(spark, path, window, ids, stamp=T1):
    return raw.load_window(documents(spark, [agreement(i) for i in ids]), path, *window, stamp)


def ids(rows):
    return sorted(r[0] for r in rows.select(F.get_json_object("dado", "$.id").cast("int")).collect())


def test_a_reader_keeps_its_state_during_loads(spark, folder):
    load(spark, folder, A, [1, 2])
    old = raw.read_raw_agreements(spark, folder)
    load(spark, folder, A, [3])
    load(spark, folder, B, [4])
    assert (ids(old), ids(raw.read_raw_agreements(spark, folder))) == ([1, 2], [3, 4])
    log = raw.agreements_log(spark, folder)
    assert [ids(log.read(log.at(version))) for version in (1, 2, 3)] == [[1, 2], [3], [3, 4]]


def test_a_load_that_stops_before_its_commit_changes_nothing(spark, folder, monkeypatch):
    load(spark, folder, A, [1, 2])

    def stop(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", stop)
        with pytest.raises(KeyboardInterrupt):
            load(spark, folder, A, [3])
    assert len(glob.glob(f"{folder}/load=*")) == 2 and ids(raw.read_raw_agreements(spark, folder)) == [1, 2]
    assert load(spark, folder, A, [4], T2).removed == 2
    assert ids(raw.read_raw_agreements(spark, folder)) == [4]


def test_a_load_that_fails_in_one_task_changes_nothing(spark, folder):
    load(spark, folder, A, [1])
    rows = spark.range(8).repartition(8)
    broken = rows.select(F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise(F.lit("{}")).alias("dado"))
    with pytest.raises(Exception, match="lost"):
        raw.load_window(broken, folder, *A, T2)
    assert ids(raw.read_raw_agreements(spark, folder)) == [1]


def test_writers_of_different_windows_both_stand(spark, folder):
    windows = [(f"2026-06-{day:02d}", f"2026-06-{day + 6:02d}") for day in range(1, 9)]
    run_together([lambda k=k, w=w: load(spark, folder, w, [k]) for k, w in enumerate(windows)], 8)
    assert ids(raw.read_raw_agreements(spark, folder)) == list(range(8))
    assert raw.agreements_log(spark, folder).latest().version == 8


def test_two_writers_of_one_window_end_as_one_of_them(spark, folder):
    jobs = [lambda k=k: load(spark, folder, A, [10 * k, 10 * k + 1]) for k in range(6)]
    reports = run_together(jobs, 6)
    found = ids(raw.read_raw_agreements(spark, folder))
    assert found in [[10 * k, 10 * k + 1] for k in range(6)]
    # Each commit saw the one before it: one load found nothing, the others two rows.
    assert sorted(report.removed for report in reports) == [0, 2, 2, 2, 2, 2]


def test_the_loser_of_a_number_takes_the_next_one(spark, folder, monkeypatch):
    """Both writers read the same state first; the second number is taken when the slower one commits."""
    load(spark, folder, A, [1])
    real, waiting = CommitLog.latest, threading.Barrier(2, timeout=60)
    first = {}

    def latest(log):
        state = real(log)
        if threading.current_thread() is not threading.main_thread() and not first.get(threading.get_ident()):
            first[threading.get_ident()] = True
            waiting.wait()
        return state

    monkeypatch.setattr(CommitLog, "latest", latest)
    log = raw.agreements_log(spark, folder)
    names = ("janela_inicio=2026-01-01/janela_fim=2026-01-07", "janela_inicio=2026-01-02/janela_fim=2026-01-08")
    done = run_together([lambda name=name: log.commit({name: Part(f"load=x/{name}", 0)}) for name in names], 2)
    assert sorted((before.version, after.version) for before, after in done) == [(1, 2), (2, 3)]
    assert set(names) < set(real(log).parts) and len(real(log).parts) == 3


def test_a_table_without_log_is_read_and_taken_over(spark, folder):
    rows = documents(spark, [amendment("a", ano=2023), amendment("b", ano=2024), amendment("c", ano=None)])
    old = rows.select("dado", F.lit(T1).cast("timestamp").alias("carregado_em"), raw.document_year(F.col("dado")).alias("ano_snapshot"))
    old.write.partitionBy("ano_snapshot").parquet(f"{folder}/raw")
    path = f"{folder}/raw"
    assert raw.read_raw_amendments(spark, path).count() == 3
    report = raw.load_snapshot(documents(spark, [amendment("b", ano=2024), amendment("d", ano=2024)]), path, T2)
    assert (report.removed, report.inserted) == (1, 2)
    found = {r[0]: r[1] for r in raw.read_raw_amendments(spark, path).groupBy("ano_snapshot").count().collect()}
    assert found == {2023: 1, 2024: 2, None: 1}


def test_windows_are_pruned_from_a_read(spark, folder):
    load(spark, folder, A, [1])
    load(spark, folder, B, [2])
    chosen = raw.read_raw_agreements(spark, folder).where(F.col("janela_fim") == F.lit(B[1]).cast("date"))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert ids(chosen) == [2] and "PartitionFilters: [isnotnull(janela_fim" in plan


def test_cleaning_keeps_what_kept_states_name(spark, folder):
    for k in range(4):
        load(spark, folder, A, [k])
    load(spark, folder, B, [9])
    log = raw.agreements_log(spark, folder)
    assert log.clean(keep_versions=2) == []  # all loads are younger than the grace time
    assert len(log.clean(keep_versions=2, grace_seconds=0)) == 3
    assert len(os.listdir(f"{folder}/_commits")) >= 2 and ids(log.read()) == [3, 9]
    assert ids(log.read(log.at(4))) == [3]
    assert load(spark, folder, A, [5]).removed == 1


def test_a_commit_that_expects_another_version_does_nothing(spark, folder):
    log = raw.agreements_log(spark, f"{folder}/raw")
    assert log.latest() == Snapshot()
    raw.made_empty(log)
    raw.made_empty(log)
    assert log.latest() == Snapshot(1, {}) and log.read().count() == 0
    assert log.commit({}, expected=0) is None

"""The newest versions kept load by load equal the full ranking."""

import os
import random

import pytest
from fixtures import agreement, documents

from outlay.plans import newest, staging
from outlay.sources import raw
from outlay.sources.commits import CommitLog
from outlay.sources.landing import ingest_records, write_landing

WINDOWS = [("2026-07-01", "2026-07-07"), ("2026-07-02", "2026-07-08"), ("2026-07-03", "2026-07-09")]


def full(log):
    return sorted(newest.latest(newest.typed(raw.read_raw(log))).collect(), key=str)


def test_any_sequence_of_loads_equals_the_full_ranking(spark, folder):
    draw = random.Random(5)
    log = raw.agreements_log(spark, f"{folder}/raw")
    state = newest.state_log(log, f"{folder}/state")
    for step in range(7):
        window = draw.choice(WINDOWS)
        ids = draw.sample(range(12), draw.choice([0, 3, 6, 9]))
        # Some loads carry an older stamp than earlier ones; some documents have no id.
        stamp = f"2026-07-{draw.randint(10, 28)} 06:00:00"
        rows = [agreement(i, valor=float(draw.randint(1, 9))) for i in ids] + [agreement(None)] * draw.randint(0, 2)
        raw.load_window(documents(spark, [*rows, agreement(0)]).limit(len(rows)), log.path, *window, stamp)
        if draw.random() < 0.7 or step == 6:
            assert sorted(newest.refresh(log, state, 4).collect(), key=str) == full(log)
    assert sorted(staging.complete_and_recent(state.read(), "2026-07-20").drop(newest.BUCKET, *raw.WINDOW_KEYS).collect(), key=str) == sorted(
        staging.stg_convenios(raw.read_raw(log), "2026-07-20").collect(), key=str
    )


def test_a_refresh_rewrites_only_touched_buckets(spark, folder):
    log = raw.agreements_log(spark, f"{folder}/raw")
    state = newest.state_log(log, f"{folder}/state")
    raw.load_window(documents(spark, [agreement(i) for i in range(40)]), log.path, *WINDOWS[0], "2026-07-10 06:00:00")
    newest.refresh(log, state, 8)
    before = state.latest()
    raw.load_window(documents(spark, [agreement(3, valor=5.0)]), log.path, *WINDOWS[1], "2026-07-11 06:00:00")
    newest.refresh(log, state, 8)
    after = state.latest()
    assert len(before.parts) > 4 and sum(before.parts[name] != after.parts[name] for name in before.parts) == 1
    assert newest.refresh(log, state, 8).count() == 40 and state.latest() == after


def test_a_state_whose_history_was_cleaned_is_made_anew(spark, folder):
    log = raw.agreements_log(spark, f"{folder}/raw")
    state = newest.state_log(log, f"{folder}/state")
    for day in range(10, 13):
        raw.load_window(documents(spark, [agreement(day), agreement(1)]), log.path, *WINDOWS[0], f"2026-07-{day} 06:00:00")
        if day == 10:
            newest.refresh(log, state, 4)
    log.clean(keep_versions=1, grace_seconds=0)
    assert sorted(newest.refresh(log, state, 4).collect(), key=str) == full(log)


def test_a_refresh_that_loses_its_commit_starts_again(spark, folder, monkeypatch):
    log = raw.agreements_log(spark, f"{folder}/raw")
    state = newest.state_log(log, f"{folder}/state")
    raw.load_window(documents(spark, [agreement(1)]), log.path, *WINDOWS[0], "2026-07-10 06:00:00")
    real, tries = CommitLog.commit, []

    def commit(this, *args, **more):
        tries.append(this.path)
        if this.path == state.path and len(tries) == 1:
            real(this, {}, source=0)  # another refresh was faster
        return real(this, *args, **more)

    monkeypatch.setattr(CommitLog, "commit", commit)
    assert sorted(newest.refresh(log, state, 4).collect(), key=str) == full(log) and len(tries) == 2


def test_reading_what_was_never_loaded_makes_no_state(spark, folder):
    log = raw.agreements_log(spark, f"{folder}/none")
    with pytest.raises(FileNotFoundError):
        raw.read_raw(log)


def test_a_refresh_ranks_new_versions_once(spark, folder):
    log = raw.agreements_log(spark, f"{folder}/raw")
    state = newest.state_log(log, f"{folder}/state")
    raw.load_window(documents(spark, [agreement(i) for i in range(9)]), log.path, *WINDOWS[0], "2026-07-10 06:00:00")
    newest.refresh(log, state, 4)
    base, before = state.latest(), log.latest()
    raw.load_window(documents(spark, [agreement(3, valor=5.0)]), log.path, *WINDOWS[1], "2026-07-11 06:00:00")
    now = log.latest().parts
    rows, touched = newest._merged(log, state, base.parts, now, *newest._changes(log, before.version, now), 4)
    lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    assert len(touched) == 1 and sum("Window [" in line for line in lines) == 1


def test_loads_and_landings_are_compressed(spark, folder):
    log = raw.agreements_log(spark, f"{folder}/raw")
    raw.load_window(documents(spark, [agreement(1)]), log.path, *WINDOWS[0], "2026-07-10 06:00:00")
    assert all(path.endswith(".zstd.parquet") for path in log.read().inputFiles())
    records = spark.createDataFrame([(1, "a"), (2, None)], "id int, nome string")
    for rows, found in ((records, 2), (records.where("id > 2"), 0)):
        path = write_landing(rows, f"{folder}/landing", "2026-07-07", "gzip")
        assert ingest_records(spark, path).count() == found
        assert any(name.endswith(".gz") for name in os.listdir(path)) and ("no-records.txt" in os.listdir(path)) == (not found)


def exchanges(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_versions_move_once_and_a_frequent_key_one_row_a_task(spark, folder):
    log = raw.agreements_log(spark, f"{folder}/raw")
    rows = [agreement(i % 40, valor=float(i)) for i in range(80)] + [agreement(None, valor=float(i)) for i in range(9)]
    raw.load_window(documents(spark, rows), log.path, *WINDOWS[0], "2026-07-10 06:00:00")
    typed = newest.typed(raw.read_raw(log))
    counts = newest._rows_by_bucket(typed, 2)
    assert sum(counts.values()) == 89
    even, hot = newest._placed(typed, 2, counts), newest._placed(typed, 9, {1: 90})
    assert exchanges(even)[0] == 1 and exchanges(hot)[0] == 2
    # Of a frequent key the tasks send one row each: the limit stands below the exchange by key.
    plan = exchanges(hot)[1]
    assert plan.index("Exchange hashpartitioning(id_convenio") < plan.rindex("WindowGroupLimit")
    for found in (even, hot):
        assert sorted(found.drop(newest.BUCKET).collect(), key=str) == full(log)

import glob
import json
from datetime import date
from decimal import Decimal

import pytest
from fixtures import agreement, amendment, documents
from pyspark.sql import functions as F

from outlay.sources import landing, raw
from outlay.streaming.landing import load_landed_intervals

A = ("2026-07-01", "2026-07-07")
B = ("2026-07-02", "2026-07-08")
T1, T2 = "2026-07-08 06:00:00", "2026-07-09 06:00:00"


def window_counts(spark, path):
    rows = raw.read_raw_agreements(spark, path).groupBy("janela_inicio", "janela_fim").count().collect()
    return {(str(r[0]), str(r[1])): r[2] for r in rows}


def year_counts(spark, path):
    return {r[0]: r[1] for r in raw.read_raw_amendments(spark, path).groupBy("ano_snapshot").count().collect()}


def test_replay_replaces_the_window(spark, folder):
    path = f"{folder}/raw"
    first = raw.load_window(documents(spark, [agreement(i) for i in (1, 2, 3)]), path, *A, T1)
    again = raw.load_window(documents(spark, [agreement(i) for i in (1, 2)]), path, *A, T2)
    assert (first.removed, first.inserted, again.removed, again.inserted) == (0, 3, 3, 2)
    assert window_counts(spark, path) == {A: 2}
    raw.load_window(documents(spark, [agreement(i) for i in (1, 2)]), path, *A, T2)
    assert window_counts(spark, path) == {A: 2}


def test_empty_replay_clears_only_its_window(spark, folder):
    path = f"{folder}/raw"
    raw.load_window(documents(spark, [agreement(i) for i in (1, 2, 3)]), path, *A, T1)
    raw.load_window(documents(spark, [agreement(4)]), path, *B, T1)
    report = raw.load_window(documents(spark, [agreement(1)]).limit(0), path, *A, T2)
    assert (report.removed, report.inserted) == (3, 0) and report.warning
    assert window_counts(spark, path) == {B: 1}


def test_overlapping_windows_keep_both_copies(spark, folder):
    path = f"{folder}/raw"
    raw.load_window(documents(spark, [agreement(1), agreement(2)]), path, *A, T1)
    raw.load_window(documents(spark, [agreement(2, valor=9.0)]), path, *B, T2)
    assert window_counts(spark, path) == {A: 2, B: 1}
    from outlay.plans.staging import stg_convenios

    stg = stg_convenios(raw.read_raw_agreements(spark, path), "2026-07-20")
    assert {r["id_convenio"]: r["valor"] for r in stg.collect()} == {1: Decimal("100.00"), 2: Decimal("9.00")}


def test_window_bounds_are_required(spark, folder):
    with pytest.raises(ValueError, match="bounds"):
        raw.load_window(documents(spark, [agreement(1)]), folder, None, "2026-07-07", T1)


def test_bad_line_leaves_the_old_window(spark, folder):
    path, source = f"{folder}/raw", f"{folder}/in.jsonl"
    raw.load_window(documents(spark, [agreement(1)]), path, *A, T1)
    with open(source, "w", encoding="utf-8") as out:
        out.write(json.dumps(agreement(2)) + "\n{bad\n")
    with pytest.raises(Exception, match="not a JSON document"):
        raw.load_window(landing.ingest_records(spark, source), path, *A, T2)
    assert window_counts(spark, path) == {A: 1}


def test_ingest_skips_blank_lines_and_reports_missing_files(spark, folder):
    source = f"{folder}/in.jsonl"
    with open(source, "w", encoding="utf-8") as out:
        out.write('{"id": 1}\n\n  \t \n  {"id": 2}  \n')
    assert sorted(r["dado"] for r in landing.ingest_records(spark, source).collect()) == ['{"id": 1}', '{"id": 2}']
    with pytest.raises(FileNotFoundError, match="land the extract"):
        landing.ingest_records(spark, f"{folder}/none.jsonl")


def test_snapshot_replaces_only_its_years(spark, folder):
    path = f"{folder}/raw"
    raw.load_snapshot(
        documents(spark, [amendment("a", ano=2023), amendment("b", ano=2024), amendment("c", ano=2024)]), path, T1
    )
    report = raw.load_snapshot(documents(spark, [amendment("b", ano=2024)]), path, T2)
    assert (report.removed, report.inserted) == (2, 1)
    assert year_counts(spark, path) == {2023: 1, 2024: 1}


def test_empty_snapshot_removes_nothing(spark, folder):
    path = f"{folder}/raw"
    raw.load_snapshot(documents(spark, [amendment("a")]), path, T1)
    report = raw.load_snapshot(documents(spark, [amendment("a")]).limit(0), path, T2)
    assert (report.removed, report.inserted) == (0, 0) and report.warning
    assert year_counts(spark, path) == {2024: 1}


def test_rows_without_a_year_stay_and_do_not_double(spark, folder):
    path = f"{folder}/raw"
    rows = documents(spark, [amendment("a"), amendment("b", ano=None), amendment("c", ano=None)])
    first, again = (raw.load_snapshot(rows, path, stamp) for stamp in (T1, T2))
    assert (first.removed, first.inserted, first.undated) == (0, 3, 2)
    assert (again.removed, again.inserted, again.undated) == (3, 3, 2)
    assert year_counts(spark, path) == {2024: 1, None: 2}
    raw.load_snapshot(documents(spark, [amendment("a")]), path, T2)
    assert year_counts(spark, path) == {2024: 1, None: 2}


def test_snapshot_files_do_not_multiply_by_tasks(spark, folder):
    path = f"{folder}/raw"
    rows = documents(spark, [amendment(str(n), ano=2020 + n % 3) for n in range(60)]).repartition(20)
    raw.load_snapshot(rows, path, T1)
    assert len(glob.glob(f"{path}/load=*/ano_snapshot=*/*.parquet")) <= 6


def test_a_large_snapshot_does_not_move(spark, folder, monkeypatch):
    """Where the tasks' own files are large enough they stay as they are."""
    rows = documents(spark, [amendment(str(n), ano=(2020 + n % 3) if n % 5 else None) for n in range(60)]).repartition(4)
    raw.load_snapshot(rows, f"{folder}/together", T1)
    monkeypatch.setattr(raw, "SMALL_FILE_BYTES", 1)
    report = raw.load_snapshot(rows, f"{folder}/own", T1)
    assert (report.inserted, report.undated) == (60, 12)
    own, together = (glob.glob(f"{folder}/{name}/load=*/ano_snapshot=*/*.parquet") for name in ("own", "together"))
    assert len(own) > 8 and len(together) <= 4
    # What was put together is there once.
    assert all(len(glob.glob(f"{folder}/{name}/load=*")) == 1 for name in ("own", "together"))
    found = [sorted(raw.read_raw_amendments(spark, f"{folder}/{name}").collect(), key=str) for name in ("own", "together")]
    assert found[0] == found[1] and len(found[0]) == 60


def test_reading_what_was_never_loaded_fails(spark, folder):
    with pytest.raises(FileNotFoundError, match="load an extract first"):
        raw.read_raw_amendments(spark, f"{folder}/none")
    assert not glob.glob(f"{folder}/none")


def test_a_table_from_before_the_year_column_is_evolved_by_a_load(spark, folder):
    path = f"{folder}/raw"
    old = documents(spark, [amendment("a", ano=2023), amendment("b", ano=2024)])
    old.withColumn("carregado_em", F.lit(T1).cast("timestamp")).write.parquet(path)
    report = raw.load_snapshot(documents(spark, [amendment("b", ano=2024)]), path, T2)
    assert (report.removed, report.inserted) == (1, 1)
    assert year_counts(spark, path) == {2023: 1, 2024: 1}
    assert spark.read.parquet(*glob.glob(f"{path}/*.parquet")).count() == 2
    assert raw.amendments_log(spark, path).latest().version == 2


def test_many_windows_in_one_load(spark, folder):
    path, base = f"{folder}/raw", f"{folder}/landing"
    raw.load_window(documents(spark, [agreement(9)]), path, *B, T1)
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    landing.write_landing(rows, base, A[1])
    landing.write_landing(rows.limit(0), base, B[1])
    windows = [tuple(date.fromisoformat(day) for day in window) for window in (A, B)]
    for removed in ([0, 1], [2, 0]):
        reports = raw.load_windows(landing.ingest_intervals(spark, base, [A[1], B[1]]), path, windows, T2)
        assert [(r.removed, r.inserted) for r in reports] == list(zip(removed, [2, 0]))
    assert window_counts(spark, path) == {A: 2} and reports[1].warning


def test_a_late_file_of_an_interval_does_not_replace_the_earlier_ones(spark, folder):
    base, path, checkpoint = f"{folder}/landing", f"{folder}/raw", f"{folder}/checkpoint"
    for ids in ([1, 2, 3], [4]):
        lines = spark.createDataFrame([('{"id": %d}' % n,) for n in ids], "value string")
        lines.write.mode("append").text(landing.landing_path(base, A[1]))
        load_landed_intervals(spark, base, path, checkpoint, T1).awaitTermination()
    assert window_counts(spark, path) == {A: 4}


def test_evolve_add_column(spark, folder):
    old = documents(spark, [amendment("a", ano=2023), amendment("b", ano=2024)])
    raw.evolve_add_column(old, f"{folder}/v1", "ano_snapshot", raw.document_year(F.col("dado")))
    once = spark.read.parquet(f"{folder}/v1")
    assert sorted(r["ano_snapshot"] for r in once.collect()) == [2023, 2024]
    raw.evolve_add_column(once, f"{folder}/v2", "ano_snapshot", F.lit(0))
    assert sorted(r["ano_snapshot"] for r in spark.read.parquet(f"{folder}/v2").collect()) == [2023, 2024]


def test_load_report_rows(spark):
    rows = raw.load_report(spark, raw.LoadReport("convenios", 3, 2), raw.LoadReport("emendas", 0, 0, 0, "empty"))
    assert [tuple(r) for r in rows.collect()] == [("convenios", 3, 2, 0, None), ("emendas", 0, 0, 0, "empty")]


def test_landing_keeps_intervals_apart(spark, folder):
    rows = spark.createDataFrame([(1, None)], "id int, nome string")
    landing.write_landing(rows, folder, "2026-07-19")
    path = landing.write_landing(rows.union(rows), folder, "2026-07-20")
    landing.write_landing(rows.union(rows), folder, "2026-07-20")
    assert [r[0] for r in spark.read.text(path).select("value").collect()] == ['{"id":1,"nome":null}'] * 2
    assert spark.read.text(landing.landing_path(folder, "2026-07-19")).count() == 1


def test_empty_landed_interval_clears_its_window(spark, folder):
    path = f"{folder}/raw"
    raw.load_window(documents(spark, [agreement(1)]), path, *A, T1)
    landed = landing.write_landing(spark.createDataFrame([], "id int"), f"{folder}/landing", A[1])
    report = raw.load_window(landing.ingest_records(spark, landed), path, *A, T2)
    assert (report.removed, report.inserted) == (1, 0)
    assert window_counts(spark, path) == {}


def test_year_may_be_text_or_number(spark, folder):
    path = f"{folder}/raw"
    raw.load_snapshot(documents(spark, [amendment("a", ano="2024"), amendment("b", ano=2024)]), path, T1)
    assert year_counts(spark, path) == {2024: 2}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        raw.load_snapshot(documents(spark, [amendment("a", ano="two")]), path, T2)
    assert year_counts(spark, path) == {2024: 2}


def test_streamed_intervals_equal_batch_loads(spark, folder):
    base, path, checkpoint = f"{folder}/landing", f"{folder}/raw", f"{folder}/checkpoint"
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id int")

    def run():
        load_landed_intervals(spark, base, path, checkpoint, T1).awaitTermination()

    landing.write_landing(rows, base, "2026-07-07")
    run()
    landing.write_landing(rows.limit(2), base, "2026-07-08")
    run()
    run()
    assert window_counts(spark, path) == {A: 3, B: 2}
    landing.write_landing(rows.limit(1), base, "2026-07-07")
    run()
    assert window_counts(spark, path) == {A: 1, B: 2}


def test_an_empty_interval_clears_its_window_in_the_stream(spark, folder):
    base, path, checkpoint = f"{folder}/landing", f"{folder}/raw", f"{folder}/checkpoint"
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    for landed in ([(A, rows), (B, rows)], [(A, rows.limit(0))]):
        for window, records in landed:
            landing.write_landing(records, base, window[1])
        load_landed_intervals(spark, base, path, checkpoint, T1).awaitTermination()
    assert window_counts(spark, path) == {B: 2}
    assert landing.read_jsonl(spark, landing.landing_path(base, A[1]), rows.schema).count() == 0

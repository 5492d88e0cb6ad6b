"""Raw document tables: idempotent loads by window and by year.

Every load is one commit of the table's log: readers see all of it or nothing,
a load that stops half-way leaves the rows before it, and loads may run side by
side.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.schemas import RAW_AGREEMENTS, RAW_AMENDMENTS
from outlay.session import setting
from outlay.sources.commits import CommitLog, Snapshot
from outlay.sources.files import children

WINDOW_KEYS = ("janela_inicio", "janela_fim")
YEAR_KEYS = ("ano_snapshot",)
NO_AGREEMENT = "no agreement in this window"
#: A task of a snapshot load writes so many years side by side; with more it sorts its rows by year first.
YEARS_AT_ONCE = 32
#: Files of a year are put together if they are smaller on average.
SMALL_FILE_BYTES = 4 * 1024 * 1024


@dataclass(frozen=True)
class LoadReport:
    table: str
    removed: int
    inserted: int
    undated: int = 0
    warning: str | None = None


def load_report(spark: SparkSession, *reports: LoadReport) -> DataFrame:
    schema = "table string, removed long, inserted long, undated long, warning string"
    return spark.createDataFrame([astuple(report) for report in reports], schema)


def agreements_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, path, RAW_AGREEMENTS, WINDOW_KEYS)


def amendments_log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, path, RAW_AMENDMENTS, YEAR_KEYS)


def read_raw(log: CommitLog) -> DataFrame:
    """A raw table as the last load left it; reading never makes one."""
    if not log.exists():
        raise FileNotFoundError(f"{log.path} does not exist: load an extract first, or check the root folder")
    return log.read()


def read_raw_agreements(spark: SparkSession, path: str) -> DataFrame:
    return read_raw(agreements_log(spark, path))


def read_raw_amendments(spark: SparkSession, path: str) -> DataFrame:
    return read_raw(amendments_log(spark, path))


def made_empty(log: CommitLog) -> None:
    """A table without rows, unless there is one."""
    if not log.exists():
        log.commit({}, expected=0)


def load_window(
    documents: DataFrame, path: str, start: date | str, end: date | str, loaded_at: datetime | str
) -> LoadReport:
    """Delete-insert of exactly the window ``(start, end)`` of the agreements table.

    Other windows stay, overlapping ones too. An empty extract clears the window.
    """
    if not start or not end:
        raise ValueError("both window bounds are required: a load must know which window it replaces")
    log = agreements_log(documents.sparkSession, path)
    rows = documents.select(
        F.col("dado"),
        F.lit(str(loaded_at)).cast("timestamp").alias("carregado_em"),
        F.lit(str(start)).cast("date").alias("janela_inicio"),
        F.lit(str(end)).cast("date").alias("janela_fim"),
    )
    return _replace_windows(log, rows, [(start, end)])[0]


def load_windows(
    documents: DataFrame, path: str, windows: list[tuple[date, date]], loaded_at: datetime | str
) -> list[LoadReport]:
    """Delete-insert of many windows in one job and one commit.

    ``documents`` has ``dado`` and ``janela_fim``, the last day of the row's
    window; ``windows`` names all windows to replace, those without rows too.
    """
    spark = documents.sparkSession
    named = spark.createDataFrame([(str(a), str(b)) for a, b in windows], "janela_inicio string, janela_fim string")
    named = named.select(F.col("janela_inicio").cast("date"), F.col("janela_fim").cast("date")).distinct()
    stamp = F.lit(str(loaded_at)).cast("timestamp").alias("carregado_em")
    # The windows of one call are a short list of the driver.
    rows = documents.join(F.broadcast(named), "janela_fim").select("dado", stamp, *WINDOW_KEYS)
    return _replace_windows(agreements_log(spark, path), rows, windows)


def _replace_windows(log: CommitLog, rows: DataFrame, windows: list[tuple]) -> list[LoadReport]:
    names = [log.partition(*window) for window in windows]
    written = log.stage(rows)
    before, _ = log.commit(written, names)
    inserted = {name: written[name].rows if name in written else 0 for name in names}
    return [
        LoadReport("convenios", log.rows_in(before, [name]), inserted[name], 0, None if inserted[name] else NO_AGREEMENT)
        for name in names
    ]


def document_year(document: Column) -> Column:
    return F.get_json_object(document, "$.ano").cast("int")


def load_snapshot(documents: DataFrame, path: str, loaded_at: datetime | str) -> LoadReport:
    """Replace exactly the years present in ``documents``; other years stay.

    Documents without a year are a partition of their own, replaced as a whole
    by a load that brings any: nothing is lost and nothing doubles, and the
    data tests see them. Each task writes the years it has, so a large snapshot
    does not move. Where that makes small files, the rows of a year are put
    together, so files do not multiply by tasks.
    """
    log = amendments_log(documents.sparkSession, path)
    stamp = F.lit(str(loaded_at)).cast("timestamp")
    dated = documents.select("dado", stamp.alias("carregado_em"), document_year(F.col("dado")).alias("ano_snapshot"))
    _evolve_snapshot(log)
    with setting(log.spark, "spark.sql.maxConcurrentOutputFileWriters", str(YEARS_AT_ONCE)):
        written = log.stage(dated)
    written = log.put_together(written, SMALL_FILE_BYTES)
    before, _ = log.commit(written)
    inserted = sum(part.rows for part in written.values())
    undated = written[log.partition(None)].rows if log.partition(None) in written else 0
    warning = "no amendment in this extract" if inserted == 0 else None
    return LoadReport("emendas", log.rows_in(before, written), inserted, undated, warning)


def _evolve_snapshot(log: CommitLog) -> None:
    """Give a raw table from before the year column that column, filled from its documents.

    The rows are written as a load of their own; the old files stay, and no reader of the log looks at them.
    """
    if not log.exists() or log.latest() != Snapshot():
        return
    old = [f"{log.path}/{name}" for name in children(log.spark, log.path) if name.endswith(".parquet")]
    if old:
        year = document_year(F.col("dado"))
        rows = log.spark.read.parquet(*old).withColumn("ano_snapshot", year).hint("rebalance", "ano_snapshot")
        log.commit(log.stage(rows), expected=0)


def evolve_add_column(
    table: DataFrame, target_path: str, column: str, backfill: Column, partition_by: tuple[str, ...] = ()
) -> None:
    """Rewrite ``table`` to ``target_path`` with ``column`` present and its nulls filled.

    The target is a new path: a table cannot be overwritten while it is read.
    """
    value = F.coalesce(F.col(column), backfill) if column in table.columns else backfill
    writer = table.withColumn(column, value).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target_path)

"""Incremental load of landed intervals with Structured Streaming.

The same delete-insert by window as the batch load; the stream's checkpoint
remembers which landed files were loaded. The stream reads the names of files
and not their lines, so an interval that lands without records (a blank line)
clears its window. A file that lands in a folder already loaded makes
the whole folder load again.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from outlay.sources.landing import ingest_intervals
from outlay.sources.raw import load_windows
from outlay.sources.windows import ROLLING_DAYS

#: What the file source tells of a file, and the interval of its folder; the content is not read.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary, janela_fim date"


def load_landed_intervals(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    checkpoint: str,
    loaded_at: datetime | str,
    days: int = ROLLING_DAYS,
) -> StreamingQuery:
    """Load all intervals landed since the last call, then stop."""
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).load(landing).select("janela_fim")

    def load(batch: DataFrame, _: int) -> None:
        # The new files say which intervals to load; a window is replaced with all of its folder.
        ends = sorted(row["janela_fim"] for row in batch.distinct().collect())
        if ends:
            session = batch.sparkSession
            replaced = [(end - timedelta(days=days - 1), end) for end in ends]
            # Replacing whole windows makes a batch that runs twice harmless.
            load_windows(ingest_intervals(session, landing, ends), raw_path, replaced, loaded_at)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

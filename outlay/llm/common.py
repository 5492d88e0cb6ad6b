"""What the operators share: input columns, working tables, integer naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.session import new_work_path

#: White space of the word definition, as a fixed value: space and U+0009 to U+000D.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_small_batches(spark: SparkSession) -> None:
    """From now on rows of this session go to Python workers in batches of ``BATCH_BYTES``, a longer row alone.

    Spark's own bound is 64 MB, which an executor holds once for each task and
    each of its Python workers once more.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), so other columns cannot clash."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def single_spaced(text: Column) -> Column:
    """The text with every run of white space replaced by one space."""
    return F.regexp_replace(text, WHITE_SPACE, " ")


def doc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


class WorkTables:
    """Intermediate tables of one run in the session's shared folder.

    A written table cuts the lineage: a lost executor costs only the tasks
    that read it, and values made once (row numbers, names) never change.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = new_work_path(spark, label)
        self._count = 0
        self._paths: dict[int, tuple[str, DataFrame]] = {}

    def keep(self, rows: DataFrame, label: str) -> DataFrame:
        """``rows`` written as Parquet and read back."""
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{label}"
        schema = rows.schema
        rows.write.parquet(path)
        table = self.spark.read.schema(schema).parquet(path)
        self._paths[id(table)] = (path, table)
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Empty tables of this run that nothing reads any more."""
        for table in tables:
            path = self._paths.pop(id(table))[0]
            # Replaced by a table without rows, which needs nothing but Spark's writer.
            self.spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


def name_in_order(work: WorkTables, keys: DataFrame, name: str) -> DataFrame:
    """Number distinct keys with integers that grow in the keys' order.

    The keys are range-partitioned and sorted; a row's number is its place in
    its partition plus the partition's number in the upper bits, so no task
    sees all keys. The table is written, so the numbers stay as they are.
    """
    columns = keys.columns
    ordered = keys.distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
    return work.keep(ordered.withColumn(name, F.monotonically_increasing_id()), f"{name}s")

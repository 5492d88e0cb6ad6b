"""Mart tables as Parquet folders, rebuilt in full by each run."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from outlay.sources.files import children, exists, read_line, remove, replace_text

STAGING = ("stg_convenios", "stg_emendas")
MARTS = (
    "dim_municipio",
    "dim_orgao_superior",
    "dim_autor_emenda",
    "dim_ano_eleitoral",
    "fct_convenios",
    "fct_emendas",
)
ROLLUP = "rollup_convenios"


#: The file that names the version readers use, and how many versions stay.
POINTER = "current-version.txt"
KEPT_VERSIONS = 2


class TableFolder:
    """Named tables under one folder.

    A table read back has a known file size, which is what Spark checks before
    it broadcasts a dimension; no join in this package carries a hint.
    """

    def __init__(self, spark: SparkSession, base: str):
        """The tables at ``base``: of the version its pointer names, else of the folder itself."""
        self.spark = spark
        self.root = base.rstrip("/")
        pointer = f"{self.root}/{POINTER}"
        self.base = f"{self.root}/{read_line(spark, pointer)}" if exists(spark, pointer) else self.root
        self._schemas: dict[str, T.StructType] = {}

    @classmethod
    def new_version(cls, spark: SparkSession, base: str) -> TableFolder:
        """An empty folder for a rebuild; readers see it only after ``make_current``."""
        folder = cls(spark, base)
        folder.base = f"{folder.root}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        return folder

    def make_current(self) -> None:
        """Let readers find this version from now on, in one step.

        The version before it stays for readers that still use it; older ones go.
        """
        replace_text(self.spark, f"{self.root}/{POINTER}", self.base.rsplit("/", 1)[1])
        versions = [name for name in children(self.spark, self.root) if name.startswith("version-")]
        for name in versions[: -KEPT_VERSIONS]:
            remove(self.spark, f"{self.root}/{name}")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, name: str, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        # Keys are hashes in hexadecimal digits, which other codecs leave at full length.
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name), compression="zstd")
        self._schemas[name] = rows.schema
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        """The table as it is on disk now; a known schema saves the job that reads it from a file."""
        reader = self.spark.read
        if name in self._schemas:
            reader = reader.schema(self._schemas[name])
        return reader.parquet(self.path(name))

    def register_views(self, names: tuple[str, ...] = MARTS) -> None:
        """Make the tables visible to ``spark.sql`` under their own names."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)

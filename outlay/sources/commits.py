"""The commit log of a raw table: every load is one step for all readers and writers.

A load writes its rows to a folder of its own and touches no older file. Then
it adds a manifest, a small numbered file that names the folder of each
partition. Readers take the newest manifest and keep its files, whatever is
loaded meanwhile; a load that stops before its manifest leaves the table as it
was. Two loads at once write apart and add their manifests one after the other:
the second one finds its number taken, takes the newer manifest as its base and
tries the next number. Different partitions then all stand; of one partition the
last load stands alone, as if the two had run one after the other.

A number is taken by a rename that does not overwrite, which the file system
must do in one step (HDFS does; on a local disk a lock of this process helps).
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.sources.files import children, create_text, exists, is_folder, listing, read_text, remove

MANIFESTS = "_commits"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Folders that no kept manifest names go after so many seconds; a slower load would lose its files.
GRACE_SECONDS = 86_400
ZSTD_LEVEL = ("parquet.compression.codec.zstd.level", 9)

_LOCK = threading.Lock()


@dataclass(frozen=True)
class Part:
    """Where the rows of a partition are, below the table's path, and how many; a table without log has no numbers."""

    folder: str
    rows: int | None = None


@dataclass(frozen=True)
class Snapshot:
    """One state of the table; version 0 is before the first commit.

    ``source`` is the version of the table that this one is derived from, if it is.
    """

    version: int = 0
    parts: dict[str, Part] = field(default_factory=dict)
    source: int = 0


class CommitLog:
    """A raw table at ``path`` with partition columns ``keys`` and the columns of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...]) -> None:
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys

    def exists(self) -> bool:
        return exists(self.spark, self.path)

    def partition(self, *values: object) -> str:
        """The name of a partition: ``key=value`` of each key, as in a folder name."""
        texts = (NULL_PARTITION if value is None else str(value) for value in values)
        return "/".join(f"{key}={text}" for key, text in zip(self.keys, texts, strict=True))

    def latest(self) -> Snapshot:
        numbers = self._versions()
        return self.at(numbers[-1]) if numbers else Snapshot(0, self._before_the_log())

    def at(self, version: int) -> Snapshot:
        """An older state, for as long as ``clean`` keeps it; ``KeyError`` after that."""
        if not exists(self.spark, self._manifest(version)):
            raise KeyError(version)
        lines = read_text(self.spark, self._manifest(version)).splitlines()
        head, *entries = map(json.loads, lines)
        return Snapshot(version, {e["partition"]: Part(e["folder"], e["rows"]) for e in entries}, head["source"])

    def read(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The rows of a state, the newest one if none is given; later loads do not change them."""
        parts = (snapshot or self.latest()).parts.values()
        rows = None
        # Folders of loads are one level deeper than those of a table without log.
        for of_a_load in (True, False):
            folders = [f"{self.path}/{part.folder}" for part in parts if part.folder.startswith("load=") == of_a_load]
            if folders:
                reader = self.spark.read.schema(self.schema).option("basePath", self.path)
                found = reader.parquet(*folders).select(*self.schema.names)
                rows = found if rows is None else rows.unionByName(found)
        return self.spark.createDataFrame([], self.schema) if rows is None else rows

    def only(self, parts: dict[str, Part]) -> DataFrame:
        """The rows of some partitions."""
        return self.read(Snapshot(0, parts))

    def stage(self, rows: DataFrame) -> dict[str, Part]:
        """Write rows where no reader looks; the partitions they make, with their numbers of rows."""
        load = f"load={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        # Documents are long, much alike and written more often than read.
        writer = rows.select(*self.schema.names).write.partitionBy(*self.keys).option(*ZSTD_LEVEL)
        writer.parquet(f"{self.path}/{load}", compression="zstd")
        # Partitions are windows or years; counting them reads no column of the files.
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/{load}")
        counted = written.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("rows")).collect()
        names = {self.partition(*[row[key] for key in self.keys]): row["rows"] for row in counted}
        return {name: Part(f"{load}/{name}", n) for name, n in names.items()}

    def put_together(self, written: dict[str, Part], least_bytes: int) -> dict[str, Part]:
        """The staged rows in few files, if the files they have are smaller than ``least_bytes`` on average.

        Small files are rewritten by partition, a large partition in several files.
        """
        files = [f for part in written.values() for f in listing(self.spark, f"{self.path}/{part.folder}")]
        sizes = [size for path, size, _ in files if path.endswith(".parquet")]
        if len(sizes) <= len(written) or sum(sizes) >= least_bytes * len(sizes):
            return written
        again = self.stage(self.only(written).hint("rebalance", *self.keys))
        for load in {part.folder.split("/")[0] for part in written.values()}:
            remove(self.spark, f"{self.path}/{load}")
        return again

    def commit(
        self, written: dict[str, Part], cleared: Iterable[str] = (), expected: int | None = None, source: int = 0
    ) -> tuple[Snapshot, Snapshot] | None:
        """Replace the written partitions and drop the cleared ones; the states before and after.

        With ``expected`` only if that is still the version, else nothing.
        """
        gone = set(cleared) - set(written)
        while True:
            before = self.latest()
            if expected is not None and before.version != expected:
                return None
            kept = {name: part for name, part in before.parts.items() if name not in gone}
            after = Snapshot(before.version + 1, {**kept, **written}, source)
            lines = [json.dumps({"source": source})]
            lines += [
                json.dumps({"partition": name, "folder": part.folder, "rows": part.rows})
                for name, part in sorted(after.parts.items())
            ]
            with _LOCK:
                if create_text(self.spark, self._manifest(after.version), "\n".join(lines)):
                    return before, after

    def rows_in(self, snapshot: Snapshot, partitions: Iterable[str]) -> int:
        """How many rows a state has in some partitions."""
        parts = {name: snapshot.parts[name] for name in partitions if name in snapshot.parts}
        known = sum(part.rows for part in parts.values() if part.rows is not None)
        uncounted = {name: part for name, part in parts.items() if part.rows is None}
        return known + (self.only(uncounted).count() if uncounted else 0)

    def clean(self, keep_versions: int = 10, grace_seconds: float = GRACE_SECONDS) -> list[str]:
        """Remove old manifests and the folders only they name; what was removed.

        A reader of a removed state loses its files, so ``keep_versions`` must
        cover the longest reader and ``grace_seconds`` the longest load.
        """
        versions = self._versions()
        kept = versions[-keep_versions:]
        named = {part.folder.split("/")[0] for version in kept for part in self.at(version).parts.values()}
        newest = time.time_ns() - int(grace_seconds * 1e9)
        loads = [name for name in children(self.spark, self.path) if name.startswith("load=")] if kept else []
        old = [name for name in loads if name not in named and int(name[5:25]) < newest]
        for version in versions[: -keep_versions]:
            remove(self.spark, self._manifest(version))
        for name in old:
            remove(self.spark, f"{self.path}/{name}")
        return old

    def _manifest(self, version: int) -> str:
        return f"{self.path}/{MANIFESTS}/{version:020d}.json"

    def _versions(self) -> list[int]:
        folder = f"{self.path}/{MANIFESTS}"
        if not exists(self.spark, folder):
            return []
        return [int(name[:-5]) for name in children(self.spark, folder) if name.endswith(".json")]

    def _before_the_log(self) -> dict[str, Part]:
        """The partition folders of a table that was written without a log."""
        if not self.exists():
            return {}
        found = [""]
        for key in self.keys:
            found = [
                f"{parent}{name}/"
                for parent in found
                for name in children(self.spark, f"{self.path}/{parent}")
                if name.startswith(f"{key}=") and is_folder(self.spark, f"{self.path}/{parent}{name}")
            ]
        return {name.rstrip("/"): Part(name.rstrip("/")) for name in found}

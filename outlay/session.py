"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join whose fact side has one very frequent key is split at run time,
    # even when the split costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of one key compress well, so a hot partition looks smaller than it is.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
}

#: A run of many jobs drops the shuffle files of each when it ends; left to the driver's garbage
#: collection they may all stay until the last one.
RELEASED_SHUFFLES = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def build_session(app_name: str = "outlay", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a while; what it was before comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder for working tables that every executor reaches.

    ``spark.checkpoint.dir`` of the session; where it is unset, a folder below
    the warehouse, which is shared as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/outlay-work"


def new_work_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def run_together(jobs: list[Callable[[], Result]], at_once: int = 4) -> list[Result]:
    """Run independent Spark jobs side by side, so one fills the tail of another.

    All jobs end before the first error, if any, is raised.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(job) for job in jobs]
    return [job.result() for job in running]

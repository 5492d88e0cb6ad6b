"""Listing, moving and small text files through the session's own file systems."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _located(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order."""
    place, system = _located(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def listing(spark: SparkSession, path: str) -> tuple:
    """Path, size and modification time of every file at or directly below ``path``."""
    place, system = _located(spark, path)
    found = [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in system.listStatus(place)]
    return tuple(sorted(found))


def read_line(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()["value"]


def is_folder(spark: SparkSession, path: str) -> bool:
    place, system = _located(spark, path)
    return system.getFileStatus(place).isDirectory()


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small text file."""
    place, system = _located(spark, path)
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small text file in one step, unless there is one: then nothing changes and the answer is no."""
    new, system = _located(spark, f"{path}.{uuid.uuid4().hex}.new")
    _write(system, new, text)
    try:
        _rename(spark, new, path, system, "NONE")
    except Py4JJavaError:
        system.delete(new, False)
        if not exists(spark, path):
            raise
        return False
    return True


def _write(system, place, text: str) -> None:
    out = system.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def _rename(spark: SparkSession, source, path: str, system, how: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = getattr(kinds, how)
    context.rename(source, jvm.org.apache.hadoop.fs.Path(path), options)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in the place of another in one step."""
    new, system = _located(spark, f"{path}.new")
    _write(system, new, text)
    _rename(spark, new, path, system, "OVERWRITE")


def remove(spark: SparkSession, path: str) -> None:
    place, system = _located(spark, path)
    system.delete(place, True)

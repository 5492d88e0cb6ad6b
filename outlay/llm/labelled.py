"""A bounded, deterministic sample of labelled documents to fit a model on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.llm.common import doc_bucket

#: Every fifth bucket is held out and never learned from.
FOLDS = 5
_AMPLE = 4


def is_held_out(docs: DataFrame):
    return (doc_bucket(docs["doc_id"], FOLDS) == 0).alias("held_out")


def smallest_hashes(ids: DataFrame, by: str, per_value: int) -> DataFrame:
    """The rows of ``ids`` (``doc_id`` and ``by``, no repeats) with the smallest id hashes, at most ``per_value`` of each value of ``by``.

    Values are counted first, and only ids below a hash that lets a few times
    the sample pass are ranked, so a frequent value does not meet in one task.
    """
    counts = ids.groupBy(by).agg(F.approx_count_distinct("doc_id").alias("n")).collect()
    # Four times the sample pass in the mean; that fewer than the sample do is out of the question.
    bounds = [min(2**64 * _AMPLE * per_value // max(row["n"], 1), 2**64 - 1) - 2**63 for row in counts]
    # An Arrow table goes to the JVM as it is; a list would start further Python workers on each executor.
    named = ids.sparkSession.createDataFrame(
        pa.table({by: [row[by] for row in counts], "_bound": pa.array(bounds, pa.int64())}),
        T.StructType([ids.schema[by], T.StructField("_bound", T.LongType())]),
    )
    # One number for each value: classes or languages, which are few.
    below = ids.join(F.broadcast(named), by).where(F.xxhash64("doc_id") <= F.col("_bound")).drop("_bound").distinct()
    order = Window.partitionBy(by).orderBy(F.xxhash64("doc_id"), "doc_id")
    return below.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= per_value).drop("_place")


def training_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``per_class`` documents of each label.

    The ids of smallest hash are taken, so the sample depends on the ids alone.
    Held-out rows, null ids and null labels never take part; of several labels
    for one document the largest counts, of several texts the first in order.
    """
    known = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[column].cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (doc_bucket(F.col("doc_id"), FOLDS) != 0))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = smallest_hashes(known, "label", per_class)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    # At most 2 * per_class pairs of numbers are broadcast.
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

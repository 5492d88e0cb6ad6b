"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from outlay.llm import quality_crf
from outlay.llm.byte_bpe_frames import round_trip
from outlay.llm.common import WorkTables, in_small_batches, read_table
from outlay.llm.decontamination import drop_contaminated
from outlay.llm.exact_dedup import drop_exact_duplicates
from outlay.llm.minhash_dedup import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not reject."""
    in_small_batches(spark)
    return quality_crf.drop_rejected(docs, quality_crf.train(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    in_small_batches(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the text decoded from its token ids, the ids and their number."""
    in_small_batches(spark)
    return round_trip(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("minhash", minhash),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``documents`` that pass all stages, encoded."""
    work = WorkTables(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs

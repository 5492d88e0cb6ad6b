"""One row per key: newest version, representative row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``, which must be a total order.

    Spark limits each input partition to one row per key before the exchange,
    so a key that holds much of the table, null included, never reaches one
    task whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_version", F.row_number().over(window)).where("_version = 1").drop("_version")


def latest_version(rows: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest row per key by ``newest`` columns, most significant first.

    Copies of one load tie on time, so every remaining column breaks the tie:
    rows that still tie are identical.
    """
    rest = [name for name in rows.columns if name not in keys and name not in newest]
    order = [F.col(name).desc_nulls_last() for name in newest] + [F.col(name).asc_nulls_last() for name in rest]
    return first_per_key(rows, keys, order)


def representative(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One distinct row per key, smallest by ``order`` and then by the other columns.

    ``distinct`` combines on the map side, so only the few spellings of each key
    are exchanged and ranked.
    """
    rest = [name for name in rows.columns if name not in keys and name not in order]
    return first_per_key(
        rows.distinct(), keys, [F.col(name).asc_nulls_last() for name in [*order, *rest]]
    )

"""Wide to long."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt_measures(
    rows: DataFrame, ids: list[str], labels: Mapping[str, str], name: str = "medida", value: str = "valor"
) -> DataFrame:
    """One row per id and measure, with the measure's label."""
    long = rows.unpivot(ids, list(labels), name, value)
    text = F.lit(None).cast("string")
    for column, label in labels.items():
        text = F.when(F.col(name) == column, label).otherwise(text)
    return long.withColumn(name, text)

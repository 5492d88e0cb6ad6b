"""Optional equality filters and cascading option lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def optional_equals(rows: DataFrame, wanted: Mapping[str, str | None]) -> DataFrame:
    """Keep rows equal to every given value; a null or empty value is no filter."""
    for column, value in wanted.items():
        if value is not None and value != "":
            rows = rows.where(F.col(column) == F.lit(value))
    return rows


def options(
    rows: DataFrame,
    columns: list[str],
    wanted: Mapping[str, str | None] | None = None,
    collation: str | None = None,
) -> DataFrame:
    """Distinct values of ``columns`` that are compatible with the chosen parents.

    ``collation`` orders the first column by the rules of a language, else bytes decide.
    """
    found = optional_equals(rows, wanted or {}).select(*columns).distinct()
    first = F.collate(F.col(columns[0]), collation) if collation else F.col(columns[0])
    return found.orderBy(first, *columns)

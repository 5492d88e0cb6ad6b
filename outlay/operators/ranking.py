"""Rankings, top-N and user-chosen order. Nulls come last in both directions."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranking(rows: DataFrame, value: str, tiebreak: Sequence[str]) -> DataFrame:
    """All rows, largest ``value`` first; ``tiebreak`` makes the order unique."""
    return rows.orderBy(F.col(value).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in tiebreak])


def top_n(rows: DataFrame, value: str, tiebreak: Sequence[str], n: int) -> DataFrame:
    return ranking(rows, value, tiebreak).limit(n)


def user_order(
    rows: DataFrame,
    column: str,
    direction: str | None,
    text_columns: Collection[str],
    then: Sequence[Column],
    collation: str = "pt",
) -> DataFrame:
    """Sort by the chosen column; text ascends and numbers descend by default.

    Rows that tie keep the order given by ``then``.
    """
    is_text = column in text_columns
    direction = direction or ("asc" if is_text else "desc")
    if direction not in ("asc", "desc"):
        raise ValueError(f"direction must be asc or desc, not {direction!r}")
    key = F.collate(F.col(column), collation) if is_text else F.col(column)
    return rows.orderBy(key.asc_nulls_last() if direction == "asc" else key.desc_nulls_last(), *then)


def found_count(found: DataFrame) -> Column:
    """How many rows the shown ones were picked from.

    Use it in the one projection above a limit: another projection in between
    would make Spark sort all rows instead of keeping the top ones.
    """
    return found.agg(F.count(F.lit(1))).scalar()

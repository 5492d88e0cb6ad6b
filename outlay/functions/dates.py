"""Dates, month labels and the election calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(day, "yyyy-MM")


def recency_bound(as_of: date | str | Column, years: int = 3) -> Column:
    """The same day ``years`` earlier (29 February becomes the 28th)."""
    return F.add_months(as_date(as_of), -12 * years)


def br_date(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def parse_br_date(text: Column) -> Column:
    return F.to_date(text, "dd/MM/yyyy")


def is_election_year(year: Column) -> Column:
    return year % 2 == 0


def election_type(year: Column) -> Column:
    """General and municipal elections alternate every two years."""
    return F.when(year % 4 == 2, "Geral").when(year % 4 == 0, "Municipal")


def mandate_year(year: Column) -> Column:
    """Position 1 to 4 within the federal mandate."""
    return (year - 3) % 4 + 1

"""Money text and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outlay.schemas import MONEY


def brl_decimal(text: Column, strict: bool = True) -> Column:
    """Brazilian-format money text as ``decimal(18,2)``.

    Null and empty give null. With a comma, dots are thousands marks and the
    comma is the decimal mark; without one the text is already a plain number
    (so ``1.234`` is 1.23). Inner spaces (``- 721,68``) are dropped. Other text
    fails when ``strict``, else gives null.
    """
    raw = text.cast("string")
    compact = F.replace(raw, F.lit(" "), F.lit(""))
    plain = F.when(
        F.instr(raw, ",") > 0,
        F.replace(F.replace(compact, F.lit("."), F.lit("")), F.lit(","), F.lit(".")),
    ).otherwise(compact)
    number = plain.cast(MONEY) if strict else plain.try_cast(MONEY)
    return F.when(raw != "", number)


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, null when ``whole`` is null or zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))

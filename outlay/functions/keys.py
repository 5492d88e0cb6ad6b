"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts joined by ``|``; null when any part is null."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(part)
    return F.md5(F.concat(*pieces) if len(pieces) > 1 else pieces[0])

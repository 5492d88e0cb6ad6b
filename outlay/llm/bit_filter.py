"""A bit field of fixed size over hashed keys: lets tasks skip rows early, before an exact step decides."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 8 MiB, whatever the number of keys. A full field lets all pass and changes no result.
BITS = 1 << 26


def bit_field(keys: DataFrame, column: str) -> np.ndarray:
    """The field over a column of 64-bit hashes; words are combined on the executors."""
    bit = F.pmod(F.col(column), F.lit(BITS))
    words = keys.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).cast("int").alias("word"))
    # At most BITS / 64 rows of one word each come to the driver.
    rows = words.agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("bits")
    ).toArrow()
    field = np.zeros(BITS // 64, dtype=np.int64)
    field[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return field.view(np.uint8)  # little-endian: bit b is in byte b // 8


def passes(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes may be among the keys."""
    bit = hashes.view(np.uint64) & np.uint64(BITS - 1)
    return (field[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

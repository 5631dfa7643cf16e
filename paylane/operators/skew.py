"""Keeping joins splittable.

Adaptive execution splits a hot key only in a join whose two inputs both come straight from an exchange. An aggregate that
is already partitioned by the join key skips its exchange, and the join then runs a hot key in one task. Grouping by one
more column, itself computed from the key, leaves the groups as they are but not the partitioning: the (small, aggregated)
side is exchanged once more, and the hot side can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOT = "_lot"


def with_lot(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumn(LOT, F.crc32(F.concat_ws("|", *keys).cast("binary")))

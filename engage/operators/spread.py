"""Spreading of rows that match nothing, so that they do not meet in one task of a join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FAN = 64


def null_salt(keys: list[str], fan: int = FAN) -> Column:
    """0 for rows with a complete key; rows with a null key, which match nothing, are dealt to buckets by their position.

    No other column is read. The 0 is written as a hash modulo 1: a literal would be folded out of the join keys of one side.
    """
    missing = F.lit(False)
    for key in keys:
        missing |= F.col(key).isNull()
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    return F.when(missing, F.pmod(F.monotonically_increasing_id(), F.lit(fan)).cast("int")).otherwise(zero)

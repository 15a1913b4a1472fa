"""Join helpers: sides of a checked size, and keys that are often NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 1024
BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table has at most so many rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def left_join_sparse_key(
    left: DataFrame, right: DataFrame, key: str, spread_by: str, spread: int = NULL_SPREAD
) -> DataFrame:
    """Left equi-join on a key that may be NULL for a large share of the left rows.

    NULL never matches, but hashing would still send all those rows to one partition. A second
    join column, constant for real keys, spreads them; the result is that of the plain join.
    """
    slot = F.when(
        F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(spread)).cast("int")
    ).otherwise(F.lit(0))
    return (
        left.withColumn("__slot", slot)
        .join(right.withColumn("__slot", F.lit(0)), [key, "__slot"], "left")
        .drop("__slot")
    )

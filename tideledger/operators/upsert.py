"""Keyed upsert as a plan: new rows replace stored rows with the same business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the highest ``order`` per key, by aggregation with map-side combine."""
    whole = F.struct(*df.columns)
    return (
        df.groupBy(*keys)
        .agg(F.max_by(whole, F.col(order)).alias("__row"))
        .select("__row.*")
    )


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is absent from the source, plus all source rows.

    Missing source columns become NULL and the target's column order and types are kept.
    """
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(align(source, target))


def align(source: DataFrame, target: DataFrame) -> DataFrame:
    have = set(source.columns)
    return source.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def without_batches(df: DataFrame, batch_ids: list[int]) -> DataFrame:
    """Rows that were not loaded by one of the given batches (rows without a batch stay)."""
    loaded_by: Column = F.col("load_batch_id").isin(batch_ids)
    return df.where(~F.coalesce(loaded_by, F.lit(False)))

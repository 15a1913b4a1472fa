"""Intermediate tables: written once to the shared folder, then read like any other table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tideledger.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Used where a plan needs the same rows several times. The files outlive lost executors, and
    their size lets Spark pick the join strategy of the next step from facts.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

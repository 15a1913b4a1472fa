"""Two-sided reconciliation in a single aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_sum: tuple[str, Column],
    right_sum: tuple[str, Column],
) -> DataFrame:
    """Sum of each side per key, keeping keys that only one side has.

    Same rows as aggregating both sides and full-joining them, at the cost of one shuffle of
    partial sums: both sides are tagged, stacked and grouped once, so a hot key is combined
    map-side. A key with a NULL part never matches the other side, as in a join. A side's sum
    is NULL where the side is absent or has only NULLs.
    """
    (l_name, l_expr), (r_name, r_expr) = left_sum, right_sum
    incomplete = F.lit(False)
    for k in keys:
        incomplete = incomplete | F.col(k).isNull()

    def tagged(df: DataFrame, side: str, mine: Column, mine_first: bool) -> DataFrame:
        nothing = F.lit(None).cast("double")
        a, b = (mine.cast("double"), nothing) if mine_first else (nothing, mine.cast("double"))
        return df.select(
            *keys,
            F.when(incomplete, F.lit(side)).alias("__side"),
            a.alias(l_name),
            b.alias(r_name),
        )

    stacked = tagged(left, "left", l_expr, True).unionByName(tagged(right, "right", r_expr, False))
    return (
        stacked.groupBy(*keys, "__side")
        .agg(F.sum(l_name).alias(l_name), F.sum(r_name).alias(r_name))
        .drop("__side")
    )

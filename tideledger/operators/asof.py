"""As-of join: the version of a row that was in force on a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AT, _VERSION, _ASKED = "__at", "__version", "__asked"


def versions_on(
    days: DataFrame, versions: DataFrame, keys: list[str], effective: str, values: list[str]
) -> DataFrame:
    """The version in force on each of ``days(*keys, __at)``: the days and the versions of a key are
    stacked, and each day takes the last version before it, one pass over the sorted dates.

    A key has at most one row per calendar day on either side, so a window's group is bounded by
    the calendar, not by the rows of a hot key. Days before the first version have none.
    """
    steps = versions.select(
        *keys, F.col(effective).alias(_AT), F.struct(*values).alias(_VERSION), F.lit(False).alias(_ASKED)
    )
    asked = days.select(
        *keys, _AT, F.lit(None).cast(steps.schema[_VERSION].dataType).alias(_VERSION),
        F.lit(True).alias(_ASKED),
    )
    present = [F.col(c).isNotNull() for c in (*keys, _AT)]
    stacked = asked.unionByName(steps)
    for condition in present:
        stacked = stacked.where(condition)
    # A version holds on its own day already: it sorts before the day that asks.
    up_to = Window.partitionBy(*keys).orderBy(_AT, _ASKED).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        stacked.withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(up_to))
        .where(F.col(_ASKED) & F.col(_VERSION).isNotNull())
        .drop(_ASKED)
    )


def asof_join(
    base: DataFrame,
    versions: DataFrame,
    keys: list[str],
    date: Column | str,
    effective: str,
    values: list[str],
    how: str = "left",
) -> DataFrame:
    """Attach to each base row the version with the latest ``effective`` <= ``date``.

    ``effective`` and ``date`` are dates; ``effective`` is unique per key. No row is compared with
    the versions of its key: the base is reduced to its distinct keys and dates (combined before
    the shuffle), these meet the versions in one sorted pass (``versions_on``), and the rows find
    their version by an equality join on keys and date, over which a hot key spreads by its dates
    and which adaptive execution can broadcast or split. Work is linear in rows plus versions. Rows
    with a NULL key or date have no version.
    """
    at = F.col(date) if isinstance(date, str) else date
    probe = base.withColumn(_AT, at)
    found = versions_on(probe.select(*keys, _AT).distinct(), versions, keys, effective, values).select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col(_AT).alias("__day"), _VERSION
    )
    on = F.col(_AT) == F.col("__day")
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    return probe.join(found, on, how).select(
        *base.columns, *[F.col(f"{_VERSION}.{v}").alias(v) for v in values]
    )


def latest_version(
    versions: DataFrame, keys: list[str], effective: str, values: list[str]
) -> DataFrame:
    """The newest version per key: one aggregation with map-side combine, no window."""
    return versions.groupBy(*keys).agg(
        *[F.max_by(v, effective).alias(v) for v in values]
    )

"""Row numbers and cut-offs for groups of any size.

A plain ``row_number()`` sorts a whole group in one task, which is fine up to a known size. Larger
groups go through one range-partitioned sort, whose bounds Spark sketches from the rows; a position
is then the start of the row's partition plus its place in it, so no window sees a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideledger.operators.staging import staged

SPLIT_ROWS = 1_000_000
CUT_BINS = 1024
CUT_POINTS = 100_000
# Layout of monotonically_increasing_id(): the partition above, the row within it below.
PLACE_BITS = 33


def globally_numbered(
    df: DataFrame, order: list[str], out: str, piece_rows: int = SPLIT_ROWS
) -> DataFrame:
    """0-based position of each row of ``df`` in the order of the ``order`` columns, NULL first.

    The rows are stored once, since both the sketch of the bounds and the sort read them. Rows
    that agree on all of ``order`` follow their stored place, so that even a value which most rows
    share is cut at a bound. Only one count per partition meets in a single task.
    """
    rows = staged(df.withColumn("__at", F.monotonically_increasing_id()), "to-number")
    pieces = max(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // piece_rows + 1
    )
    keys = [*order, "__at"]
    placed = staged(
        rows.repartitionByRange(pieces, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__at", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("__piece", F.shiftright("__at", PLACE_BITS))
    earlier = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("__piece")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__piece", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    )
    inside = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # One row per partition of the sort.
    return (
        placed.join(F.broadcast(starts), "__piece")
        .withColumn(out, F.col("__start") + inside)
        .drop("__piece", "__at", "__start")
    )


def ordered_position(
    df: DataFrame,
    group: list[str],
    steps: list[str],
    tail: list[str],
    out: str,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """1-based position of each row within ``group``, ordered by ``steps`` then ``tail``.

    Group sizes are counted first: groups of up to ``split_rows`` rows are numbered by a plain
    window and only larger ones are sorted across tasks. A NULL in ``group`` is a group like any
    other.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__size"))
    hot = sizes.where(F.col("__size") > split_rows).select(*group)
    small = F.row_number().over(Window.partitionBy(*group).orderBy(*steps, *tail)).cast("bigint")
    if hot.isEmpty():
        return df.withColumn(out, small)
    keys = staged(hot, "hot-groups").select(*[F.col(g).alias(f"__{g}") for g in group])
    same = same_group(group)
    cold = df.join(keys, same, "left_anti").withColumn(out, small)
    large = position_across_tasks(df.join(keys, same, "left_semi"), group, steps + tail, out, split_rows)
    return cold.unionByName(large.select(*cold.columns))


def same_group(group: list[str]) -> Column:
    """Equality of ``group`` with the columns of the same names behind two underscores."""
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    return same


def position_across_tasks(
    df: DataFrame, group: list[str], order: list[str], out: str, piece_rows: int
) -> DataFrame:
    """Position within groups of any size: all groups are sorted together, and a group starts at
    the smallest of its positions."""
    numbered = globally_numbered(df, group + order, "__spot", piece_rows)
    # One row per group, stored: Spark then sees whether it can be sent to the rows, so that these do not
    # meet in a task per group.
    starts = staged(
        numbered.groupBy(*[F.col(g).alias(f"__{g}") for g in group]).agg(F.min("__spot").alias("__first")),
        "group-starts",
    )
    return (
        numbered.join(starts, same_group(group))
        .withColumn(out, F.col("__spot") - F.col("__first") + 1)
        .drop("__spot", "__first", *[f"__{g}" for g in group])
    )


def weighted_cut(
    rows: DataFrame,
    group: list[str],
    value: str,
    weight: str,
    wanted: DataFrame,
    k: str,
    out: str,
    before: str,
    bins: int = CUT_BINS,
    points: int = CUT_POINTS,
) -> DataFrame:
    """Per group, the value at which the running weight in ascending order reaches ``k``.

    ``wanted`` has one row per group with ``k`` >= 1. Returns the group, ``k``, the cut value
    ``out`` and the weight strictly ``before`` it. While a group has more than ``points`` distinct
    values, the range they span is cut into equal bins and only the bin that holds the cut is kept;
    its range is measured anew, so neither an outlier nor nearly equal values leave much in it.
    The last step orders at most ``points`` values of a group.
    """
    left = staged(
        rows.groupBy(*group, value)
        .agg(F.sum(weight).alias("__n"))
        .join(wanted.select(*group, k), group)
        .withColumn("__passed", F.lit(0).cast("bigint")),
        "cut-values",
    )
    while True:
        span = left.groupBy(*group).agg(
            F.min(value).alias("__lo"), F.max(value).alias("__hi"),
            F.count(F.lit(1)).alias("__values"),
        )
        if not (span.agg(F.max("__values")).first()[0] or 0) > points:
            break
        left = staged(_bin_of_cut(left, span, group, value, k, bins, points), "cut-values")
    running = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        left.withColumn(
            before, F.col("__passed") + F.coalesce(F.sum("__n").over(running), F.lit(0))
        )
        .where((F.col(before) < F.col(k)) & (F.col(k) <= F.col(before) + F.col("__n")))
        .select(*group, k, F.col(value).alias(out), before)
    )


def _bin_of_cut(
    left: DataFrame, span: DataFrame, group: list[str], value: str, k: str, bins: int, points: int
) -> DataFrame:
    """The values in the bin that holds each group's cut, and the weight passed before it."""
    # Halves, since the width of a range may be beyond what a double holds.
    low, high, at = (F.col(c).cast("double") / 2 for c in ("__lo", "__hi", value))
    place = F.least(F.floor((at - low) / (high - low) * bins), F.lit(bins - 1))
    # The smallest value stays apart where values are too close for the division.
    place = F.when(F.col(value) > F.col("__lo"), F.greatest(place, F.lit(0)) + 1).otherwise(F.lit(0))
    binned = left.join(span, group).withColumn(
        "__bin", F.when(F.col("__values") > points, place).otherwise(F.lit(0)).cast("int")
    )
    running = Window.partitionBy(*group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.col("__passed") + F.coalesce(F.sum("__weight").over(running), F.lit(0))
    held = (
        binned.groupBy(*group, k, "__passed", "__bin")
        .agg(F.sum("__n").alias("__weight"))
        .withColumn("__before", passed)
        .where((F.col("__before") < F.col(k)) & (F.col(k) <= F.col("__before") + F.col("__weight")))
        .select(*group, "__bin", F.col("__before").cast("bigint").alias("__before"))
    )
    return binned.join(held, [*group, "__bin"]).select(
        *group, value, "__n", k, F.col("__before").alias("__passed")
    )

"""Column helpers shared by the plans. All of them stay inside Spark's built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_key(date: Column | str) -> Column:
    """'YYYY-MM' of a date."""
    return F.date_format(col(date), "yyyy-MM")


def period_end(period: Column | str) -> Column:
    """Last day of a 'YYYY-MM' period."""
    return F.last_day(F.to_date(F.concat(col(period), F.lit("-01"))))


def week_start(date: Column | str) -> Column:
    """Monday of the date's week."""
    return F.to_date(F.date_trunc("week", col(date)))


def or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def ratio(n: Column | str, d: Column | str, otherwise: Column | float | None = None) -> Column:
    """n / d where d > 0, else the given value."""
    other = otherwise if isinstance(otherwise, Column) else F.lit(otherwise).cast("double")
    return F.when(col(d) > 0, col(n) / col(d)).otherwise(other)


def relative_gap(delta: Column | str, base: Column | str) -> Column:
    """delta / |base|; with a zero base, 1 if there is any gap at all and else 0."""
    d, b = col(delta), F.abs(col(base))
    return F.when(b > 0, d / b).otherwise(F.when(F.abs(d) > 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def n_unique(c: Column | str) -> Column:
    """Distinct count in which NULL counts as one more value."""
    return F.count_distinct(col(c)) + F.coalesce(F.max(col(c).isNull().cast("bigint")), F.lit(0))


def sum_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition holds (NULL counts as no)."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def pick(key: Column | str, values: dict[str, object], default: object) -> Column:
    """Value of a small fixed dictionary, or the default."""
    out = None
    for k, v in values.items():
        out = (F if out is None else out).when(col(key) == k, F.lit(v))
    return out.otherwise(F.lit(default))


def bucket_label(days: Column | str, edges: list[int]) -> Column:
    """Range label of a day count; the upper edge of a range is exclusive."""
    d = col(days)
    out = F.when(d.isNull(), F.lit("N/A")).when(d < 0, F.lit("EXPIRED"))
    for low, high in zip(edges, edges[1:]):
        out = out.when(d < high, F.lit(f"{low}-{high}d"))
    return out.otherwise(F.lit(f">{edges[-1]}d"))


def stable_id(prefix: str, *parts: Column | str) -> Column:
    """Id that depends on the parts only, so a rerun gives the same id."""
    text = F.concat_ws("|", *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(text, 256), 1, 16)))

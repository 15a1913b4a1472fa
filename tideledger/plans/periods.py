"""One period of the marts and facts, so that every board can be shown for one period or for all."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import period_end

# The facts by the names the marts use, with the column that tells a row's month.
EVENTS = {
    name: config.CONTRACTS[f"fact_{table}"].event
    for name, table in {
        "order": "order", "shipment": "shipment", "returns": "return", "po": "po", "receipt": "receipt",
        "settlement": "settlement", "charge": "charge_actual",
    }.items()
}


def periods(*frames: DataFrame) -> DataFrame:
    """The periods to choose from, newest first; rows without a period offer none."""
    found = None
    for df in frames:
        own = df.select("period").where(F.col("period").isNotNull()).distinct()
        found = own if found is None else found.unionByName(own)
    return found.distinct().orderBy(F.desc("period"))


def in_period(df: DataFrame, period: str, event: str = "period") -> DataFrame:
    """Rows of one 'YYYY-MM' period. Dates are compared with the month's first and last day, not
    formatted, so that the predicate reaches the scan."""
    if dict(df.dtypes).get(event) != "date":
        return df.where(F.col(event) == period)
    last = period_end(F.lit(period))
    return df.where((F.col(event) >= F.trunc(last, "month")) & (F.col(event) <= last))


class OnePeriod:
    """Marts as a board sees them once a period is chosen: marts that carry a period and the facts
    named in ``EVENTS`` show its rows, everything else (policies, rates, stock) is unchanged."""

    def __init__(self, source: Any, period: str, events: dict[str, str] | None = None):
        self._source, self._period, self._events = source, period, events or {}

    @property
    def facts(self) -> OnePeriod:
        return OnePeriod(self._source.facts, self._period, EVENTS)

    def __getattr__(self, name: str) -> Any:
        value = getattr(self._source, name)
        if not isinstance(value, DataFrame):
            return value
        event = self._events.get(name, "period")
        if event not in value.columns or (self._events and name not in self._events):
            return value
        return in_period(value, self._period, event)

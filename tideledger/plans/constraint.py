"""Constraint signals, their causes, actions and effect."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import count_where, month_key, stable_id

SIGNAL_COLUMNS = [
    "signal_id", "domain", "metric_name", "current_value", "threshold_value", "severity",
    "entity_type", "entity_id", "period",
]


def signal(
    df: DataFrame,
    domain: str,
    metric: str,
    value: Column,
    threshold: float,
    severity: Column,
    entity_type: str,
    entity: Column,
    digits: int | None = None,
) -> DataFrame:
    """Rows of ``df`` as signals; the value is rounded after the severity was decided."""
    shown = value if digits is None else F.round(value, digits)
    return df.select(
        stable_id("SIG-", F.lit(domain), F.lit(metric), entity, "period").alias("signal_id"),
        F.lit(domain).alias("domain"),
        F.lit(metric).alias("metric_name"),
        shown.cast("double").alias("current_value"),
        F.lit(float(threshold)).alias("threshold_value"),
        severity.alias("severity"),
        F.lit(entity_type).alias("entity_type"),
        entity.alias("entity_id"),
        F.col("period").cast("string").alias("period"),
    )


def _graded(value: Column, critical_from: float) -> Column:
    return F.when(value >= critical_from, F.lit("CRITICAL")).otherwise(F.lit("HIGH"))


def late_po(
    po: DataFrame,
    receipt: DataFrame,
    as_of_date: dt.date,
    threshold: float = config.LATE_PO_RATIO_HIGH,
) -> DataFrame:
    """Share of a supplier's monthly lines past their ETA on a PO without any receipt."""
    overdue = F.col("eta_date") < F.lit(as_of_date)
    # One row per PO before the join keeps a PO with very many lines from piling up.
    lines = po.groupBy("supplier_id", month_key("po_date").alias("period"), "po_id").agg(
        F.count(F.lit(1)).alias("lines"), count_where(overdue).alias("overdue")
    )
    received = (
        receipt.where(F.col("po_id").isNotNull())
        .select("po_id", F.lit(True).alias("has_receipt"))
        .distinct()
    )
    late = F.when(F.col("has_receipt").isNull(), F.col("overdue")).otherwise(F.lit(0))
    rates = (
        lines.join(received, "po_id", "left")
        .groupBy("supplier_id", "period")
        .agg((F.sum(late) / F.sum("lines")).alias("rate"))
        .where(F.col("rate") >= threshold)
    )
    rate = F.col("rate")
    return signal(
        rates, "supply", "late_po_ratio", rate, threshold, _graded(rate, threshold * 1.5),
        "supplier", F.col("supplier_id"), 4,
    )


def delay_sums(po: DataFrame, receipt: DataFrame) -> DataFrame:
    """Days from ETA to receipt and receipts, summed per supplier, order month, warehouse and month of
    receipt: receipts are counted per PO line before the join, and both delay signals read the sums."""
    day = F.unix_date("receipt_date")
    arrivals = (
        receipt.where(F.col("po_id").isNotNull())
        .withColumn("receipt_month", month_key("receipt_date"))
        .groupBy("po_id", "item_id", "warehouse_id", "receipt_month")
        .agg(F.count("receipt_date").alias("arrivals"), F.sum(day).alias("day_sum"))
    )
    due = po.where(F.col("eta_date").isNotNull()).select(
        "po_id", "item_id", "supplier_id", "eta_date", month_key("po_date").alias("po_month")
    )
    gap = F.col("day_sum") - F.col("arrivals") * F.unix_date("eta_date")
    return (
        arrivals.join(due, ["po_id", "item_id"])
        .groupBy("supplier_id", "po_month", "warehouse_id", "receipt_month")
        .agg(F.sum(gap).alias("gap"), F.sum("arrivals").alias("arrivals"))
    )


def _mean_delay(sums: DataFrame, group: list[Column | str]) -> DataFrame:
    return sums.groupBy(*group).agg((F.sum("gap") / F.sum("arrivals")).alias("days"))


def supplier_delay(
    po: DataFrame, receipt: DataFrame, threshold: float = config.SUPPLIER_DELAY_DAYS_HIGH,
    sums: DataFrame | None = None,
) -> DataFrame:
    """``sums`` are those of ``delay_sums``, where they are made already."""
    days = F.col("days")
    sums = delay_sums(po, receipt) if sums is None else sums
    slow = _mean_delay(sums, ["supplier_id", F.col("po_month").alias("period")]).where(
        days >= threshold
    )
    return signal(
        slow, "supply", "supplier_delay_days", days, threshold, _graded(days, threshold * 2),
        "supplier", F.col("supplier_id"), 1,
    )


def dwell_time(
    po: DataFrame, receipt: DataFrame, threshold: float = config.DWELL_DAYS_HIGH,
    sums: DataFrame | None = None,
) -> DataFrame:
    """``sums`` are those of ``delay_sums``, where they are made already."""
    days = F.col("days")
    sums = delay_sums(po, receipt) if sums is None else sums
    slow = _mean_delay(sums, ["warehouse_id", F.col("receipt_month").alias("period")]).where(
        days >= threshold
    )
    return signal(
        slow, "logistics_customs", "dwell_time_days", days, threshold, F.lit("HIGH"),
        "warehouse", F.col("warehouse_id"), 1,
    )


def open_lines(order: DataFrame, shipment: DataFrame) -> DataFrame:
    """Order lines, counted per order, item, warehouse and month, that no shipment covers."""
    lines = order.groupBy(
        "channel_order_id", "item_id",
        F.coalesce("ship_from_warehouse_id", F.lit("UNKNOWN")).alias("warehouse_id"),
        month_key("order_date").alias("period"),
    ).agg(F.count(F.lit(1)).alias("lines"), F.sum("qty_ordered").alias("qty_ordered"))
    covered = shipment.select("channel_order_id", "item_id").distinct()
    return lines.join(covered, ["channel_order_id", "item_id"], "left_anti")


def backlog(
    order: DataFrame, shipment: DataFrame, threshold: float = config.BACKLOG_ORDERS_HIGH
) -> DataFrame:
    count = F.col("backlog")
    waiting = (
        open_lines(order, shipment)
        .groupBy("warehouse_id", "period")
        .agg(F.sum("lines").alias("backlog"))
        .where(count >= threshold)
    )
    return signal(
        waiting, "warehouse_3pl", "backlog_ship_orders", count, threshold,
        _graded(count, threshold * 2), "warehouse", F.col("warehouse_id"),
    )


def return_spike(
    returns: DataFrame, shipment: DataFrame, threshold: float = config.RETURN_RATE_HIGH
) -> DataFrame:
    """Quantity returned on an order in a month over everything shipped that month."""
    returned = returns.groupBy(
        F.coalesce("channel_order_id", F.lit("UNKNOWN")).alias("channel"),
        month_key("return_date").alias("period"),
    ).agg(F.sum("qty_returned").alias("returned"))
    shipped = shipment.groupBy(month_key("ship_date").alias("period")).agg(
        F.sum("qty_shipped").alias("shipped")
    )
    rate = F.col("rate")
    high = (
        returned.join(shipped, "period", "left")
        .withColumn(
            "rate", F.try_divide("returned", F.coalesce(F.col("shipped"), F.lit(1.0)))
        )
        .where(rate >= threshold)
    )
    return signal(
        high, "demand_channel", "return_rate_spike", rate, threshold, F.lit("HIGH"),
        "channel", F.col("channel"), 4,
    )


def expired_stock(onhand: DataFrame) -> DataFrame:
    """Expired quantity per item, warehouse and snapshot day; always critical."""
    expired = (
        onhand.where(F.col("expired_qty") > 0)
        .groupBy("item_id", "warehouse_id", F.col("snapshot_date").cast("string").alias("period"))
        .agg(F.sum("expired_qty").alias("expired"))
    )
    return signal(
        expired, "finance", "expired_value_at_risk", F.col("expired"), 0.0, F.lit("CRITICAL"),
        "item", F.concat_ws("|", "item_id", "warehouse_id"),
    )


def constraint_signals(
    order: DataFrame,
    shipment: DataFrame,
    returns: DataFrame,
    po: DataFrame,
    receipt: DataFrame,
    onhand: DataFrame,
    as_of_date: dt.date,
    late_po_ratio: float = config.LATE_PO_RATIO_HIGH,
    delay_days: float = config.SUPPLIER_DELAY_DAYS_HIGH,
    backlog_orders: float = config.BACKLOG_ORDERS_HIGH,
    dwell_days: float = config.DWELL_DAYS_HIGH,
    return_rate: float = config.RETURN_RATE_HIGH,
) -> DataFrame:
    sums = delay_sums(po, receipt)
    return reduce(
        DataFrame.unionByName,
        [
            late_po(po, receipt, as_of_date, late_po_ratio),
            supplier_delay(po, receipt, delay_days, sums),
            backlog(order, shipment, backlog_orders),
            dwell_time(po, receipt, dwell_days, sums),
            return_spike(returns, shipment, return_rate),
            expired_stock(onhand),
        ],
    )


def signal_issues(signals: DataFrame) -> DataFrame:
    """Critical signals as issue-log rows; append through ``expiry.new_issues``."""
    return signals.where(F.col("severity") == "CRITICAL").select(
        F.col("signal_id").alias("issue_id"),
        F.concat(F.lit("CONSTRAINT_"), "metric_name").alias("issue_type"),
        "severity", "domain", "entity_type", "entity_id", "period",
        F.concat(
            "metric_name", F.lit("="), F.col("current_value").cast("string"),
            F.lit(" exceeds threshold "), F.col("threshold_value").cast("string"),
        ).alias("detail"),
    )


def _rule(signals: DataFrame, columns: dict[str, tuple[int, str]]) -> DataFrame:
    """Attach columns of the six-row rule table, with defaults for unknown metrics."""
    rules = signals.sparkSession.createDataFrame(
        [(r[0], *[r[i] for i, _ in columns.values()]) for r in config.SIGNAL_RULES],
        ", ".join(["metric_name string", *[f"{c} string" for c in columns]]),
    )
    # Six fixed rows.
    return signals.join(F.broadcast(rules), "metric_name", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(default)) for c, (_, default) in columns.items()}
    )


def root_causes(signals: DataFrame) -> DataFrame:
    cause, factors = config.SIGNAL_CAUSE_DEFAULT
    serious = signals.where(F.col("severity").isin("CRITICAL", "HIGH"))
    return _rule(
        serious, {"root_cause": (1, cause), "contributing_factors": (2, factors)}
    ).select("signal_id", "root_cause", "contributing_factors", "domain", "period")


def action_plan(signals: DataFrame) -> DataFrame:
    action, priority, owner = config.SIGNAL_ACTION_DEFAULT
    return _rule(
        signals, {"action": (3, action), "priority": (4, priority), "responsible": (5, owner)}
    ).select("signal_id", "action", "priority", "responsible", "domain", "period")


def effectiveness(issue_log: DataFrame, signals: DataFrame) -> DataFrame:
    """Before and after of signals whose issue was resolved."""
    resolved = issue_log.where(F.col("resolved_at").isNotNull()).select(
        F.col("issue_id").alias("signal_id"), "period"
    )
    before = F.col("current_value")
    return resolved.join(
        signals.select("signal_id", "metric_name", "current_value"), "signal_id"
    ).select(
        "signal_id", "metric_name", before.alias("before_value"),
        F.lit(0.0).alias("after_value"), (-before).alias("delta"),
        F.lit(True).alias("resolved"), "period",
    )

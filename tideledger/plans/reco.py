"""Reconciliation marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import month_key, or_zero, ratio, relative_gap
from tideledger.operators.reconcile import reconcile


def inventory_movement(
    snapshot: DataFrame,
    receipt: DataFrame,
    shipment: DataFrame,
    returns: DataFrame,
    warn: float = config.ADJUSTMENT_RATIO_WARN,
    high: float = config.ADJUSTMENT_RATIO_HIGH,
) -> DataFrame:
    """Day-to-day stock movement per warehouse and item.

    Yesterday's stock, today's stock and the three movements are stacked under today's date
    and grouped once, in place of five aggregations and four joins. A day counts only when the
    day before has a snapshot too; rows of other days are left out before they are grouped. The
    residual is booked as adjustment.
    """
    measures = ["prev_onhand", "actual_onhand", "receipts", "shipments", "returns"]

    def entry(df: DataFrame, day: Column, measure: str, qty: str) -> DataFrame:
        return df.select(
            day.alias("snapshot_date"),
            "warehouse_id",
            "item_id",
            *[(F.col(qty) if m == measure else F.lit(None).cast("double")).alias(m)
              for m in measures],
            F.lit(measure == "prev_onhand").alias("is_prev"),
            F.lit(measure == "actual_onhand").alias("is_actual"),
        )

    day = F.col("snapshot_date")
    days = snapshot.select(day.alias("__day")).distinct()
    # One row per calendar day with snapshots at most. An unknown day pairs with itself, as in a group.
    paired = days.join(
        days.select(F.date_add("__day", 1).alias("__next")),
        F.col("__day").eqNullSafe(F.col("__next")), "left_semi",
    )
    stacked = reduce(
        DataFrame.unionByName,
        [
            entry(snapshot, day, "actual_onhand", "onhand_qty"),
            entry(snapshot, F.date_add(day, 1), "prev_onhand", "onhand_qty"),
            entry(receipt, F.col("receipt_date"), "receipts", "qty_received"),
            entry(shipment, F.col("ship_date"), "shipments", "qty_shipped"),
            entry(returns, F.col("return_date"), "returns", "qty_returned"),
        ],
    )
    moves = (
        stacked.join(F.broadcast(paired), day.eqNullSafe(F.col("__day")), "left_semi")
        .groupBy("snapshot_date", "warehouse_id", "item_id")
        .agg(
            *[F.sum(m).alias(m) for m in measures],
            F.max("is_prev").alias("has_prev"),
            F.max("is_actual").alias("has_actual"),
        )
        .where(F.col("has_prev") & F.col("has_actual"))
        .withColumns({m: or_zero(m) for m in ["receipts", "shipments", "returns"]})
    )
    explained = F.col("prev_onhand") + F.col("receipts") - F.col("shipments") + F.col("returns")
    share = relative_gap(F.abs("adjustments"), "prev_onhand")
    return (
        moves.withColumn("adjustments", F.col("actual_onhand") - explained)
        .withColumn("expected_onhand", explained - F.col("adjustments"))
        .withColumn("delta", F.col("actual_onhand") - F.col("expected_onhand"))
        .select(
            "snapshot_date", "warehouse_id", "item_id", "prev_onhand", "receipts", "shipments",
            "returns", "adjustments", "expected_onhand", "actual_onhand", "delta",
            relative_gap("delta", "prev_onhand").alias("delta_ratio"),
            F.when(share >= high, F.lit("high"))
            .when(share >= warn, F.lit("warn"))
            .otherwise(F.lit("ok"))
            .alias("severity"),
        )
    )


def _with_delta(df: DataFrame, left: str, right: str, delta: str = "delta") -> DataFrame:
    return df.withColumns({left: or_zero(left), right: or_zero(right)}).withColumn(
        delta, F.col(left) - F.col(right)
    )


def oms_vs_wms(order: DataFrame, shipment: DataFrame) -> DataFrame:
    """Ordered against shipped quantity per period, item and store."""
    keys = ["period", "item_id", "channel_store_id"]
    both = reconcile(
        order.withColumn("period", month_key("order_date")),
        shipment.where(F.col("channel_store_id").isNotNull()).withColumn(
            "period", month_key("ship_date")
        ),
        keys,
        ("oms_qty_ordered", F.col("qty_ordered")),
        ("wms_qty_shipped", F.col("qty_shipped")),
    )
    return _with_delta(both, "oms_qty_ordered", "wms_qty_shipped").withColumn(
        "fulfillment_rate", ratio("wms_qty_shipped", "oms_qty_ordered")
    )


def erp_vs_wms_receipt(receipt: DataFrame) -> DataFrame:
    """Receipts booked by ERP systems against those booked by WMS systems, in one pass."""
    system = F.upper("source_system")
    erp, wms = system.contains("ERP"), system.contains("WMS")
    qty = F.col("qty_received")
    sums = (
        receipt.where(F.col("po_id").isNotNull() & (erp | wms))
        .groupBy(month_key("receipt_date").alias("period"), "item_id", "po_id")
        .agg(F.sum(F.when(erp, qty)).alias("erp_qty"), F.sum(F.when(wms, qty)).alias("wms_qty"))
    )
    return _with_delta(sums, "erp_qty", "wms_qty")


def settlement_vs_estimated(
    settlement: DataFrame, exchange_rate: DataFrame, revenue_mart: DataFrame
) -> DataFrame:
    """Settled against estimated revenue; a settlement without a rate counts at 1.0."""
    rates = exchange_rate.select("period", "currency", "rate_to_krw")
    settled = settlement.join(rates, ["period", "currency"], "left")
    both = reconcile(
        settled,
        revenue_mart,
        ["period", "channel_store_id", "item_id"],
        (
            "settlement_revenue_krw",
            or_zero("net_payout") * F.coalesce(F.col("rate_to_krw"), F.lit(1.0)),
        ),
        ("estimated_revenue_krw", F.col("net_revenue_krw")),
    )
    return _with_delta(
        both, "settlement_revenue_krw", "estimated_revenue_krw", "delta_krw"
    ).withColumn("variance_pct", relative_gap("delta_krw", "estimated_revenue_krw"))


def charges_invoice_vs_allocated(
    charge: DataFrame, allocated: DataFrame, tolerance: float = config.TIE_TOLERANCE
) -> DataFrame:
    """Invoiced against allocated amounts per period and charge type."""
    both = reconcile(
        charge,
        allocated,
        ["period", "charge_type"],
        ("invoice_total", F.col("amount")),
        ("allocated_total", F.col("allocated_amount")),
    )
    return _with_delta(both, "invoice_total", "allocated_total").withColumn(
        "tied", F.abs("delta") < tolerance
    )


def untied_charges(reco: DataFrame) -> DataFrame:
    """The rows that need attention, as CRITICAL findings."""
    return reco.where(~F.col("tied")).select(F.lit("CRITICAL").alias("severity"), "*")

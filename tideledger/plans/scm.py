"""Supply-chain marts. Each builder takes DataFrames and returns a lazy DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import (
    count_where,
    month_key,
    n_unique,
    or_zero,
    pick,
    ratio,
    sum_or_zero,
    week_start,
)
from tideledger.operators.asof import asof_join
from tideledger.operators.joins import left_join_sparse_key
from tideledger.plans import expiry

INFINITE = float("inf")


def sales_only(df: DataFrame) -> DataFrame:
    """Rows that belong to a customer order; transfers carry no order id."""
    return df.where(F.col("channel_order_id").isNotNull())


def lot_state(snapshot: DataFrame, item: DataFrame) -> DataFrame:
    """Every lot row with expiry, sellable split and bucket: the input of four marts."""
    return expiry.expiry_bucket(expiry.sellable_quantity(expiry.lot_expiry(snapshot, item)))


def inventory_onhand(snapshot: DataFrame, item: DataFrame) -> DataFrame:
    return expiry.fefo_rank(lot_state(snapshot, item)).select(
        "snapshot_date", "warehouse_id", "item_id", "lot_id", "onhand_qty", "sellable_qty",
        "blocked_qty", "expired_qty", "final_expiry_date", "expiry_bucket", "fefo_rank",
        F.col("effective_min_sellable_days").alias("min_sellable_days"),
    )


def fefo_pick_list(snapshot: DataFrame, item: DataFrame) -> DataFrame:
    """Lots with their picking order; the stored mart is written in that order."""
    return expiry.fefo_rank(
        expiry.sellable_quantity(expiry.lot_expiry(snapshot, item))
    ).select(
        "warehouse_id", "item_id", "lot_id", "onhand_qty", "sellable_qty",
        "final_expiry_date", "fefo_rank", "snapshot_date",
    )


def open_po(po: DataFrame, receipt: DataFrame, as_of_date: dt.date) -> DataFrame:
    """Purchase-order lines against what was received, with delay and lead times."""
    received = (
        receipt.where(F.col("po_id").isNotNull())
        .groupBy("po_id", "item_id")
        .agg(
            F.sum("qty_received").alias("qty_received"),
            F.min("receipt_date").alias("first_receipt_date"),
        )
    )
    today = F.lit(as_of_date)
    eta, first = F.col("eta_date"), F.col("first_receipt_date")
    return (
        po.join(received, ["po_id", "item_id"], "left")
        .withColumn("qty_received", or_zero("qty_received"))
        .select(
            "po_id", "item_id", "supplier_id", "po_date", "eta_date", "first_receipt_date",
            "qty_ordered", "qty_received",
            F.greatest(F.col("qty_ordered") - F.col("qty_received"), F.lit(0.0)).alias("qty_open"),
            F.when(eta < today, F.datediff(today, eta)).otherwise(F.lit(0)).alias("delay_days"),
            F.datediff(first, F.col("po_date")).alias("po_lead_days"),
            F.datediff(first, eta).alias("eta_vs_actual_days"),
            month_key("po_date").alias("period"),
        )
    )


def daily_demand(shipment: DataFrame) -> DataFrame:
    """Average units sold per calendar day between first and last sale, per warehouse, item."""
    span = F.greatest(F.datediff(F.max("ship_date"), F.min("ship_date")) + 1, F.lit(1))
    return (
        sales_only(shipment)
        .groupBy("warehouse_id", "item_id")
        .agg((F.sum("qty_shipped") / span).alias("avg_daily_demand"))
    )


def days_of_stock(qty: str) -> Column:
    return ratio(qty, "avg_daily_demand", INFINITE)


def stockout_risk(
    snapshot: DataFrame,
    item: DataFrame,
    shipment: DataFrame,
    threshold_days: int = config.STOCKOUT_DAYS_COVER,
) -> DataFrame:
    """Days of cover per warehouse and item.

    Sellable stock is summed over all snapshots while the as-of date and the on-hand fallback
    come from the latest one, as the specified figures do.
    """
    by_day = (
        expiry.sellable_quantity(expiry.lot_expiry(snapshot, item))
        .groupBy("warehouse_id", "item_id", "snapshot_date")
        .agg(
            F.sum("onhand_qty").alias("onhand_qty"),
            sum_or_zero("sellable_qty").alias("sellable_qty"),
        )
    )
    stock = by_day.groupBy("warehouse_id", "item_id").agg(
        F.coalesce(F.sum("sellable_qty"), F.max_by("onhand_qty", "snapshot_date")).alias(
            "sellable_qty"
        ),
        F.max("snapshot_date").alias("as_of_date"),
    )
    return (
        stock.join(daily_demand(shipment), ["warehouse_id", "item_id"], "left")
        .withColumn("avg_daily_demand", or_zero("avg_daily_demand"))
        .withColumn("days_of_cover", days_of_stock("sellable_qty"))
        .withColumn("threshold_days", F.lit(threshold_days).cast("int"))
        .select(
            "item_id", "warehouse_id", "sellable_qty", "avg_daily_demand", "days_of_cover",
            "threshold_days",
            (F.col("days_of_cover") < F.col("threshold_days")).alias("risk_flag"),
            "as_of_date",
        )
    )


def overstock(snapshot: DataFrame, item: DataFrame, shipment: DataFrame) -> DataFrame:
    """Days on hand against the limit of the item type; stock is summed over all snapshots."""
    # Summing per warehouse and item first keeps the item join at one row per pair.
    totals = snapshot.groupBy("warehouse_id", "item_id").agg(
        F.sum("onhand_qty").alias("onhand_qty"), F.max("snapshot_date").alias("as_of_date")
    )
    limit = pick("item_type", config.DOH_OVERSTOCK, config.DOH_OVERSTOCK_DEFAULT).cast("int")
    excess = F.col("onhand_qty") - F.col("avg_daily_demand") * F.col("doh_threshold")
    return (
        totals.join(item.select("item_id", "item_type"), "item_id", "left")
        .withColumn("item_type", F.coalesce("item_type", F.lit("FG")))
        .join(daily_demand(shipment), ["warehouse_id", "item_id"], "left")
        .withColumn("avg_daily_demand", or_zero("avg_daily_demand"))
        .withColumn("days_on_hand", days_of_stock("onhand_qty"))
        .withColumn("doh_threshold", limit)
        .withColumn("overstock_flag", F.col("days_on_hand") > F.col("doh_threshold"))
        .withColumn(
            "overstock_qty",
            F.when(F.col("overstock_flag"), F.greatest(excess, F.lit(0.0))).otherwise(F.lit(0.0)),
        )
        .select(
            "item_id", "warehouse_id", "item_type", "onhand_qty", "avg_daily_demand",
            "days_on_hand", "doh_threshold", "overstock_flag", "overstock_qty", "as_of_date",
        )
    )


def unit_costs(cost: DataFrame, name: str = "unit_cost_krw") -> DataFrame:
    """Cost components summed to one unit cost per item and effective date."""
    return cost.groupBy("item_id", "effective_from").agg(F.sum("cost_per_unit_krw").alias(name))


def expiry_risk(snapshot: DataFrame, item: DataFrame, cost: DataFrame) -> DataFrame:
    """Lots with an expiry date, valued at the cost in force on the snapshot day."""
    lots = expiry.expiry_bucket(expiry.lot_expiry(snapshot, item)).where(
        F.col("final_expiry_date").isNotNull()
    )
    return asof_join(
        lots, unit_costs(cost), ["item_id"], "snapshot_date", "effective_from", ["unit_cost_krw"]
    ).select(
        "item_id", "warehouse_id", "lot_id", "onhand_qty", "final_expiry_date", "days_to_expiry",
        "expiry_bucket",
        (F.col("onhand_qty") * F.col("unit_cost_krw")).alias("risk_value_krw"),
        F.col("snapshot_date").alias("as_of_date"),
    )


def service_level(order: DataFrame, shipment: DataFrame) -> DataFrame:
    """Weekly share of order lines whose order first shipped within the promise window."""
    # Lines are counted per order first, so an order with very many lines is one row below.
    lines = order.groupBy("channel_order_id", "order_date", "channel_store_id").agg(
        F.count(F.lit(1)).alias("lines")
    )
    shipped = (
        sales_only(shipment)
        .groupBy("channel_order_id")
        .agg(F.min("ship_date").alias("earliest_ship_date"))
    )
    on_time = F.col("earliest_ship_date") <= F.date_add("order_date", config.PROMISE_DAYS)
    return (
        lines.join(shipped, "channel_order_id", "left")
        .groupBy(week_start("order_date").alias("week_start"), "channel_store_id")
        .agg(
            F.sum("lines").alias("total_orders"),
            F.sum(F.when(on_time, F.col("lines")).otherwise(F.lit(0))).alias("shipped_on_time"),
        )
        .withColumn("service_level_pct", ratio("shipped_on_time", "total_orders", 0.0))
    )


def shipment_performance(shipment: DataFrame, order: DataFrame) -> DataFrame:
    """Monthly volume and timeliness per warehouse and store.

    Volume needs no order data. Timeliness needs the order date only, so shipments are
    counted per order, day, warehouse and store before they meet the orders.
    """
    keys = ["period", "warehouse_id", "channel_store_id"]
    volume = shipment.groupBy(
        month_key("ship_date").alias("period"), "warehouse_id", "channel_store_id"
    ).agg(
        n_unique("shipment_id").alias("total_shipments"),
        sum_or_zero("qty_shipped").alias("total_qty_shipped"),
        sum_or_zero("weight").alias("total_weight"),
        sum_or_zero("volume_cbm").alias("total_volume_cbm"),
        F.avg("qty_shipped").alias("avg_qty_per_shipment"),
    )
    ordered = (
        sales_only(order).groupBy("channel_order_id").agg(F.min("order_date").alias("order_date"))
    )
    lines = sales_only(shipment).groupBy(
        "channel_order_id", "ship_date", "warehouse_id", "channel_store_id"
    ).agg(F.count(F.lit(1)).alias("lines"))
    lead = F.datediff("ship_date", "order_date")
    timely = (
        lines.join(ordered, "channel_order_id")
        .groupBy(month_key("ship_date").alias("period"), "warehouse_id", "channel_store_id")
        .agg(
            (F.sum(lead * F.col("lines")) / F.sum("lines")).alias("avg_lead_days"),
            F.sum(
                F.when(
                    F.col("ship_date") <= F.date_add("order_date", config.PROMISE_DAYS),
                    F.col("lines"),
                ).otherwise(F.lit(0))
            ).alias("on_time_count"),
        )
    )
    same = None
    for k in keys:
        match = F.col(f"v.{k}").eqNullSafe(F.col(f"t.{k}"))
        same = match if same is None else same & match
    return (
        volume.alias("v")
        .join(timely.alias("t"), same, "left")
        .select(
            *[F.col(f"v.{k}") for k in keys],
            "total_shipments", "total_qty_shipped", "total_weight", "total_volume_cbm",
            "avg_qty_per_shipment", "avg_lead_days",
            F.coalesce("on_time_count", F.lit(0)).cast("bigint").alias("on_time_count"),
        )
        .withColumn("on_time_pct", ratio("on_time_count", "total_shipments", 0.0))
    )


def shipment_daily(shipment: DataFrame) -> DataFrame:
    return shipment.groupBy("ship_date", "warehouse_id").agg(
        n_unique("shipment_id").alias("shipment_count"),
        sum_or_zero("qty_shipped").alias("qty_shipped"),
        sum_or_zero("weight").alias("weight"),
        sum_or_zero("volume_cbm").alias("volume_cbm"),
        n_unique("channel_order_id").alias("unique_orders"),
        n_unique("item_id").alias("unique_items"),
    )


def return_analysis(returns: DataFrame, order: DataFrame, shipment: DataFrame) -> DataFrame:
    """Returns by month, item, warehouse, store, reason and disposition, against shipments.

    An order that has lines in two stores counts its returns in both.
    """
    stores = sales_only(order).select("channel_order_id", "channel_store_id").distinct()
    with_store = left_join_sparse_key(
        returns.withColumn("period", month_key("return_date")),
        stores, "channel_order_id", "return_id",
    )
    counted = with_store.groupBy(
        "period", "item_id", "warehouse_id", "channel_store_id", "reason", "disposition"
    ).agg(
        n_unique("return_id").alias("return_count"),
        sum_or_zero("qty_returned").alias("qty_returned"),
    )
    shipped = shipment.groupBy(
        month_key("ship_date").alias("period"), "item_id", "warehouse_id"
    ).agg(F.sum("qty_shipped").alias("qty_shipped"))
    return counted.join(shipped, ["period", "item_id", "warehouse_id"], "left").select(
        "period", "item_id", "warehouse_id", "channel_store_id", "reason", "disposition",
        "return_count", "qty_returned", "qty_shipped",
        ratio("qty_returned", "qty_shipped", 0.0).alias("return_rate"),
    )


def return_daily(returns: DataFrame) -> DataFrame:
    """Daily returns per warehouse with the most frequent reason (lowest one on a tie)."""
    keys = ["return_date", "warehouse_id"]
    volume = returns.groupBy(*keys).agg(
        n_unique("return_id").alias("return_count"),
        sum_or_zero("qty_returned").alias("qty_returned"),
        n_unique("channel_order_id").alias("unique_orders"),
        n_unique("item_id").alias("unique_items"),
    )
    top = (
        returns.where(F.col("reason").isNotNull())
        .groupBy(*keys, "reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys)
        .agg(F.min(F.struct((-F.col("n")).alias("n"), "reason"))["reason"].alias("top_reason"))
    )
    return volume.join(top, keys, "left")

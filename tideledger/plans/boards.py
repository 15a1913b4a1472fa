"""Dashboard queries over the marts. Aggregation stays in the cluster; results are small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import count_where, or_zero, pick, ratio, sum_or_zero
from tideledger.operators.asof import latest_version
from tideledger.plans.constraint import open_lines
from tideledger.plans.scm import sales_only, unit_costs

TOP = 10


def rows() -> Column:
    return F.count(F.lit(1))


def for_period(df: DataFrame, period: str | None) -> DataFrame:
    """One period of a mart, or all of them."""
    return df if period is None else df.where(F.col("period") == period)


def stack(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _latest_cost(cost: DataFrame) -> DataFrame:
    return latest_version(unit_costs(cost), ["item_id"], "effective_from", ["unit_cost_krw"])


# ---- inventory --------------------------------------------------------------------------


def inventory_kpis(onhand: DataFrame) -> DataFrame:
    sums = onhand.agg(
        *[F.sum(c).alias(c) for c in ("onhand_qty", "sellable_qty", "blocked_qty", "expired_qty")]
    )
    return sums.withColumn("blocked_ratio", ratio("blocked_qty", "onhand_qty"))


def inventory_value(onhand: DataFrame, cost: DataFrame) -> DataFrame:
    """Stock value at the latest unit cost; items without cost are counted, not valued."""
    qty = {
        "onhand_qty": "total_value", "sellable_qty": "sellable_value",
        "blocked_qty": "hold_value", "expired_qty": "expired_value",
    }
    # Per item first: one row per item meets its cost.
    items = onhand.groupBy("item_id").agg(
        *[F.sum(q).alias(q) for q in qty], rows().alias("lots")
    )
    known = F.col("unit_cost_krw").isNotNull()
    return items.join(_latest_cost(cost), "item_id", "left").agg(
        *[F.sum(F.col(q) * F.col("unit_cost_krw")).alias(v) for q, v in qty.items()],
        F.sum(F.when(known, F.col("lots")).otherwise(0)).alias("lots_with_cost"),
        F.sum(F.when(known, 0).otherwise(F.col("lots"))).alias("lots_without_cost"),
    )


def inventory_by_warehouse_type(onhand: DataFrame, warehouse: DataFrame) -> DataFrame:
    measures = ("onhand_qty", "sellable_qty", "blocked_qty")
    pairs = onhand.groupBy("warehouse_id", "item_id").agg(*[F.sum(m).alias(m) for m in measures])
    return (
        pairs.join(warehouse, "warehouse_id", "left")
        .groupBy(
            F.coalesce("warehouse_type", F.lit("UNKNOWN")).alias("warehouse_type"),
            F.coalesce("country", F.lit("KR")).alias("country"),
        )
        .agg(
            *[F.sum(m).alias(m) for m in measures],
            F.count_distinct("item_id").alias("sku_count"),
        )
        .orderBy(F.desc("onhand_qty"))
    )


def onhand_by_bucket(onhand: DataFrame) -> DataFrame:
    return onhand.groupBy("expiry_bucket").agg(F.sum("onhand_qty").alias("onhand_qty"))


# ---- purchasing -------------------------------------------------------------------------


def po_kpis(open_po: DataFrame) -> DataFrame:
    return open_po.agg(
        rows().alias("po_lines"),
        F.sum("qty_open").alias("qty_open"),
        count_where(F.col("delay_days") > 0).alias("delayed"),
        F.avg("po_lead_days").alias("avg_lead_days"),
        F.min("po_lead_days").alias("min_lead_days"),
        F.max("po_lead_days").alias("max_lead_days"),
    )


def eta_accuracy(open_po: DataFrame) -> DataFrame:
    gap = F.col("eta_vs_actual_days")
    return open_po.where(F.col("po_lead_days").isNotNull() & gap.isNotNull()).agg(
        F.avg(gap).alias("avg_gap_days"),
        count_where(gap <= 0).alias("on_time"),
        count_where(gap > 0).alias("late"),
    )


def lead_time_by_supplier(open_po: DataFrame) -> DataFrame:
    return (
        open_po.where(F.col("po_lead_days").isNotNull())
        .groupBy("supplier_id")
        .agg(F.avg("po_lead_days").alias("avg_lead_days"), rows().alias("po_count"))
        .orderBy(F.desc("avg_lead_days"), "supplier_id")
    )


# ---- shipments and returns --------------------------------------------------------------


def shipment_kpis(performance: DataFrame) -> DataFrame:
    return performance.agg(
        F.sum("total_shipments").alias("total_shipments"),
        F.sum("total_qty_shipped").alias("total_qty_shipped"),
        F.sum("total_weight").alias("total_weight"),
        F.avg("on_time_pct").alias("avg_on_time_pct"),
        F.avg("avg_lead_days").alias("avg_lead_days"),
    )


def shipments_by(performance: DataFrame, key: str) -> DataFrame:
    """Shipments per warehouse or per channel; rows without the key are left out."""
    return performance.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("total_shipments").alias("total_shipments"),
        F.sum("total_qty_shipped").alias("total_qty_shipped"),
        F.avg("on_time_pct").alias("avg_on_time_pct"),
    )


def backlog_totals(order: DataFrame, shipment: DataFrame) -> DataFrame:
    return open_lines(sales_only(order), shipment).agg(
        F.count_distinct("channel_order_id").alias("open_orders"),
        sum_or_zero("qty_ordered").alias("open_qty"),
    )


def matching_rates(order: DataFrame, shipment: DataFrame) -> DataFrame:
    """How many orders and lines have a shipment."""
    lines = sales_only(order).groupBy("channel_order_id").agg(rows().alias("lines"))
    shipped = sales_only(shipment).groupBy("channel_order_id").agg(rows().alias("shipped"))
    totals = lines.join(shipped, "channel_order_id", "left").agg(
        rows().alias("total_orders"),
        F.count("shipped").alias("matched_orders"),
        F.sum("lines").alias("total_lines"),
        F.coalesce(F.sum("shipped"), F.lit(0)).alias("matched_lines"),
    )
    return totals.withColumns(
        {
            "order_match_rate": ratio("matched_orders", "total_orders"),
            "line_match_rate": ratio("matched_lines", "total_lines"),
        }
    )


def daily_totals(daily: DataFrame, day: str, count: str, qty: str) -> DataFrame:
    return (
        daily.groupBy(day)
        .agg(F.sum(count).alias(count), F.sum(qty).alias(qty))
        .orderBy(day)
    )


def return_kpis(analysis: DataFrame) -> DataFrame:
    return analysis.agg(
        F.sum("return_count").alias("total_returns"),
        F.sum("qty_returned").alias("qty_returned"),
        F.sum("qty_shipped").alias("qty_shipped"),
    ).withColumn("return_rate", ratio("qty_returned", "qty_shipped", 0.0))


def returns_by(analysis: DataFrame, key: str) -> DataFrame:
    """Returned quantity per reason or disposition; rows without the key are left out."""
    return (
        analysis.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum("qty_returned").alias("qty_returned"))
        .orderBy(F.desc("qty_returned"))
    )


def top_return_items(analysis: DataFrame, n: int = TOP) -> DataFrame:
    return (
        analysis.groupBy("item_id")
        .agg(
            F.sum("qty_returned").alias("qty_returned"),
            sum_or_zero("qty_shipped").alias("qty_shipped"),
            F.sum("return_count").alias("return_count"),
        )
        .withColumn(
            "return_rate",
            F.when(
                F.col("qty_shipped") > 0, F.col("qty_returned") / F.col("qty_shipped") * 100
            ).otherwise(F.lit(0.0)),
        )
        .orderBy(F.desc("return_rate"), "item_id")
        .limit(n)
    )


# ---- stock risk -------------------------------------------------------------------------


def flagged_count(mart: DataFrame, flag: str) -> DataFrame:
    return mart.agg(rows().alias("items"), count_where(F.col(flag)).alias("flagged"))


def turnover(onhand: DataFrame, shipment: DataFrame) -> DataFrame:
    """Units sold over mean stock per item."""
    stock = onhand.groupBy("item_id").agg(F.avg("onhand_qty").alias("avg_onhand"))
    sold = sales_only(shipment).groupBy("item_id").agg(F.sum("qty_shipped").alias("shipped_qty"))
    return (
        stock.join(sold, "item_id", "left")
        .withColumn("shipped_qty", or_zero("shipped_qty"))
        .withColumn("turnover_ratio", ratio("shipped_qty", "avg_onhand"))
    )


def turnover_kpis(items: DataFrame, slow_below: float = 0.5) -> DataFrame:
    return items.agg(
        F.avg("turnover_ratio").alias("avg_turnover"),
        count_where(F.col("turnover_ratio") < slow_below).alias("slow_items"),
    )


def slowest_items(items: DataFrame, n: int = TOP) -> DataFrame:
    return items.orderBy(F.asc_nulls_first("turnover_ratio"), "item_id").limit(n)


def overstock_value(overstock: DataFrame, cost: DataFrame) -> DataFrame:
    return (
        overstock.where(F.col("overstock_flag"))
        .join(_latest_cost(cost), "item_id", "left")
        .select(
            "item_id", "warehouse_id", "overstock_qty", "unit_cost_krw",
            (F.col("overstock_qty") * F.col("unit_cost_krw")).alias("overstock_value"),
        )
    )


def overstock_value_kpis(valued: DataFrame) -> DataFrame:
    return valued.agg(
        F.sum("overstock_value").alias("overstock_value"),
        count_where(F.col("unit_cost_krw").isNull()).alias("without_cost"),
    )


def top_overstock(valued: DataFrame, n: int = TOP) -> DataFrame:
    return valued.orderBy(F.desc_nulls_last("overstock_value"), "item_id", "warehouse_id").limit(n)


def expiry_kpis(risk: DataFrame) -> DataFrame:
    return risk.agg(
        rows().alias("lots"),
        F.sum("onhand_qty").alias("onhand_qty"),
        F.sum("risk_value_krw").alias("risk_value_krw"),
        count_where(F.col("risk_value_krw").isNull()).alias("without_value"),
        F.avg("days_to_expiry").alias("avg_days"),
        F.min("days_to_expiry").alias("min_days"),
    )


def expiry_buckets(risk: DataFrame) -> DataFrame:
    return risk.groupBy("expiry_bucket").agg(
        F.sum("onhand_qty").alias("onhand_qty"),
        F.count("item_id").alias("lots"),
        sum_or_zero("risk_value_krw").alias("risk_value_krw"),
    )


def fefo_top(pick_list: DataFrame, n: int = 50) -> DataFrame:
    return pick_list.orderBy(
        F.asc_nulls_last("fefo_rank"), "warehouse_id", "item_id", "lot_id", "snapshot_date"
    ).limit(n)


def service_level_mean(weekly: DataFrame) -> DataFrame:
    return weekly.agg(F.avg("service_level_pct").alias("avg_service_level"))


def service_level_series(weekly: DataFrame) -> DataFrame:
    return weekly.orderBy("week_start", "channel_store_id")


# ---- constraints and reconciliation -----------------------------------------------------


def signal_counts(signals: DataFrame) -> DataFrame:
    severity = F.col("severity")
    return signals.agg(
        count_where(severity == "CRITICAL").alias("critical"),
        count_where(severity == "HIGH").alias("high"),
        rows().alias("signals"),
    )


def resolved_share(effect: DataFrame) -> DataFrame:
    return effect.agg(count_where(F.col("resolved")).alias("resolved"), rows().alias("signals"))


def reco_summary(
    movement: DataFrame,
    oms_wms: DataFrame,
    erp_wms: DataFrame,
    settlement: DataFrame,
    charges: DataFrame,
) -> DataFrame:
    """One row per reconciliation: rows, open issues, gaps and rates."""

    def area(name: str, df: DataFrame, issue: Column, **measures: Column) -> DataFrame:
        named = [c.alias(n) for n, c in measures.items()]
        return df.agg(rows().alias("rows"), count_where(issue).alias("issues"), *named).select(
            F.lit(name).alias("area"), "*"
        )

    def gaps(delta: str) -> dict[str, Column]:
        return {"delta_sum": F.sum(delta), "delta_abs": F.sum(F.abs(delta))}

    def relative(df: DataFrame, base: str) -> DataFrame:
        share = F.when(F.col(base) != 0, F.col("delta_abs") / F.abs(base)).otherwise(F.lit(0.0))
        return df.withColumn("delta_ratio", share).drop(base)

    differs = F.col("delta") != 0
    return stack(
        area("inventory_movement", movement, F.lower("severity").isin("warn", "high")),
        area("oms_vs_wms", oms_wms, differs, **gaps("delta"),
             mean_rate=F.avg("fulfillment_rate")),
        area("erp_vs_wms_receipt", erp_wms, differs),
        relative(
            area("settlement_vs_estimated", settlement, F.col("delta_krw") != 0,
                 **gaps("delta_krw"), base=F.sum("settlement_revenue_krw")),
            "base",
        ),
        relative(
            area("charges_invoice_vs_allocated", charges, ~F.col("tied"), **gaps("delta"),
                 base=F.sum("invoice_total")),
            "base",
        ),
    )


# ---- profit and loss --------------------------------------------------------------------


def waterfall(summary: DataFrame, period: str | None = None) -> DataFrame:
    return for_period(summary, period).orderBy("period", "metric_order")


def revenue_kpis(revenue: DataFrame) -> DataFrame:
    actual = F.col("coverage_flag") == "ACTUAL"
    sums = revenue.agg(
        *[
            F.sum(c).alias(c)
            for c in ("gross_sales_krw", "discounts_krw", "refunds_krw", "net_revenue_krw")
        ],
        count_where(actual).alias("actual_rows"),
        count_where(~actual).alias("partial_rows"),
    )
    gross = F.col("gross_sales_krw")
    return sums.withColumn(
        "discount_rate", F.when(gross != 0, F.abs("discounts_krw") / F.abs(gross))
    )


def revenue_by_store(revenue: DataFrame) -> DataFrame:
    return (
        revenue.groupBy("channel_store_id")
        .agg(F.sum("net_revenue_krw").alias("net_revenue_krw"))
        .orderBy(F.desc("net_revenue_krw"))
    )


def coverage_totals(df: DataFrame, amount: str, name: str) -> DataFrame:
    """Sum over fully covered rows, sum with gaps as zero, and row counts."""
    actual = F.col("coverage_flag") == "ACTUAL"
    return df.agg(
        F.sum(F.when(actual, F.col(amount))).alias("known_sum"),
        F.sum(or_zero(amount)).alias("total_sum_min"),
        rows().alias("total_count"),
        (rows() - count_where(actual)).alias("partial_count"),
        count_where(actual).alias("actual_count"),
    ).select(F.lit(name).alias("mart"), "*")


def mean_over_actual(df: DataFrame, pct: str, name: str) -> DataFrame:
    return df.where(F.col("coverage_flag") == "ACTUAL").agg(F.avg(pct).alias("avg_pct")).select(
        F.lit(name).alias("mart"), "avg_pct"
    )


def amount_by(df: DataFrame, key: str) -> DataFrame:
    """Allocated amount per domain or stage, largest first."""
    return (
        df.groupBy(key)
        .agg(F.sum("allocated_amount_krw").alias("allocated_amount_krw"))
        .orderBy(F.desc("allocated_amount_krw"))
    )


def logistics_ratio(variable_cost: DataFrame, revenue: DataFrame) -> DataFrame:
    """Transport and 3PL cost over net revenue: two one-row totals put side by side."""
    logistics = F.col("charge_domain").isin("logistics_transport", "3pl_billing")
    cost = variable_cost.where(logistics).select(
        F.col("allocated_amount_krw").alias("cost"), F.lit(None).cast("double").alias("net")
    )
    net = revenue.select(
        F.lit(None).cast("double").alias("cost"), F.col("net_revenue_krw").alias("net")
    )
    return (
        cost.unionByName(net)
        .agg(sum_or_zero("cost").alias("logistics_krw"), sum_or_zero("net").alias("revenue_krw"))
        .withColumn("logistics_ratio", ratio("logistics_krw", "revenue_krw"))
    )


def unit_costs_per_sale(
    variable_cost: DataFrame, shipment: DataFrame, min_share: float = 0.8
) -> DataFrame:
    """Variable cost per order, piece, kilogram and cubic metre.

    The last two only where enough shipment lines carry the measure.
    """
    totals = variable_cost.agg(F.sum("allocated_amount_krw").alias("total_vc"))

    volume = sales_only(shipment).agg(
        F.count_distinct("channel_order_id").alias("orders"),
        F.sum("qty_shipped").alias("qty"),
        F.sum("weight").alias("weight"),
        F.sum("volume_cbm").alias("volume"),
        F.try_divide(count_where(or_zero("weight") != 0), rows()).alias("weight_coverage"),
        F.try_divide(count_where(or_zero("volume_cbm") != 0), rows()).alias("volume_coverage"),
    )
    # Both sides are global aggregates of one row each.
    both = totals.withColumn("one", F.lit(1)).join(volume.withColumn("one", F.lit(1)), "one")
    vc = F.col("total_vc")

    def per(measure: str, coverage: str | None = None) -> Column:
        usable = F.col(measure) > 0
        if coverage:
            usable = usable & (F.col(coverage) >= min_share)
        return F.when(usable, vc / F.col(measure))

    return both.select(
        "total_vc",
        per("orders").alias("vc_per_order"),
        per("qty").alias("vc_per_piece"),
        per("weight", "weight_coverage").alias("vc_per_kg"),
        per("volume", "volume_coverage").alias("vc_per_cbm"),
        "weight_coverage",
        "volume_coverage",
    )


def profitability(contribution: DataFrame, key: str) -> DataFrame:
    """Contribution per item or store, with a mark where any row is not fully covered."""
    return (
        contribution.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.sum("contribution_krw").alias("contribution_krw"),
            F.avg("contribution_pct").alias("contribution_pct"),
            F.bool_or(F.col("coverage_flag") != "ACTUAL").alias("is_partial"),
        )
    )


def best_and_worst(ranking: DataFrame, key: str, n: int = TOP) -> DataFrame:
    best = ranking.orderBy(F.desc("contribution_krw"), key).limit(n)
    worst = ranking.orderBy(F.asc("contribution_krw"), key).limit(n)
    return stack(
        best.withColumn("side", F.lit("TOP")), worst.withColumn("side", F.lit("BOTTOM"))
    )


def coverage_counts(coverage: DataFrame) -> DataFrame:
    severity = F.col("severity")
    return coverage.agg(
        *[count_where(severity == s).alias(s.lower()) for s in ("OK", "WARN", "CRITICAL")],
        rows().alias("cells"),
    )


def fx_coverage(settlement: DataFrame, exchange_rate: DataFrame) -> DataFrame:
    """Foreign currencies per period and whether a rate is known."""
    used = (
        settlement.where(F.col("currency") != "KRW").select("period", "currency").distinct()
    )
    known = F.col("rate_to_krw").isNotNull()
    return (
        used.join(exchange_rate, ["period", "currency"], "left")
        .select(
            "period", "currency",
            F.when(known, F.lit("OK")).otherwise(F.lit("MISSING")).alias("status"),
        )
        .orderBy("period", "currency")
    )


def coverage_flags(marts: dict[str, DataFrame]) -> DataFrame:
    """Row counts by coverage flag for each profit-and-loss mart."""
    actual = F.col("coverage_flag") == "ACTUAL"
    return stack(
        *[
            df.agg(rows().alias("total"), count_where(actual).alias("actual")).select(
                F.lit(name).alias("mart"),
                "total",
                "actual",
                (F.col("total") - F.col("actual")).alias("partial"),
                ratio(F.col("actual") * 100, "total", 0.0).alias("actual_pct"),
            )
            for name, df in marts.items()
        ]
    )


# ---- cost scenarios ---------------------------------------------------------------------


def basis_totals(
    order: DataFrame, shipment: DataFrame, inventory: DataFrame, item: DataFrame,
    revenue: DataFrame,
) -> DataFrame:
    """Quantity that each allocation basis is priced by, one row per basis.

    Stock days use the mean daily stock times 30.
    """
    volume = item.select("item_id", "volume_cbm")
    stock = (
        inventory.groupBy("snapshot_date", "item_id")
        .agg(F.sum("onhand_qty").alias("onhand_qty"))
        .join(volume, "item_id", "left")
        .agg(
            F.sum("onhand_qty").alias("qty"),
            sum_or_zero(F.col("onhand_qty") * F.col("volume_cbm")).alias("cbm"),
            F.count_distinct("snapshot_date").alias("days"),
        )
    )
    orders = order.agg(
        F.count_distinct("channel_order_id").cast("double").alias("orders"),
        rows().cast("double").alias("lines"),
    )
    shipped = shipment.agg(
        sum_or_zero("qty_shipped").alias("qty"),
        sum_or_zero("weight").alias("weight"),
        sum_or_zero("volume_cbm").alias("volume"),
    )
    earned = revenue.agg(sum_or_zero("net_revenue_krw").alias("net"))

    def entries(df: DataFrame, **basis: Column) -> DataFrame:
        pairs = [
            F.struct(F.lit(b).alias("basis"), q.cast("double").alias("basis_qty"))
            for b, q in basis.items()
        ]
        return df.select(F.explode(F.array(*pairs)).alias("e")).select("e.*")

    per_day = lambda c: F.coalesce(F.try_divide(c, F.col("days")), F.lit(0.0)) * 30
    return stack(
        entries(orders, order_count=F.col("orders"), line_count=F.col("lines")),
        entries(shipped, qty=F.col("qty"), weight=F.col("weight"), volume_cbm=F.col("volume")),
        entries(earned, value=F.col("net"), revenue=F.col("net")),
        entries(
            stock,
            onhand_qty_days=per_day(F.col("qty")),
            onhand_cbm_days=per_day(F.col("cbm")),
        ),
    )


def scenario_costs(prices: DataFrame, totals: DataFrame) -> DataFrame:
    """Estimated cost per scenario and charge type.

    ``prices`` has scenario, charge_type and unit_price; a price of zero leaves the charge
    out, and a basis without a total is priced by shipped quantity.
    """
    default_basis = {name: basis for name, _, _, _, basis, _ in config.CHARGE_POLICY}
    stage = {name: s for name, _, s, _, _, _ in config.CHARGE_POLICY}
    fallback = totals.where(F.col("basis") == "qty").select(F.col("basis_qty").alias("any_qty"))
    # ``totals`` has one row per basis.
    known = F.broadcast(totals)
    return (
        prices.where(F.col("unit_price") > 0)
        .withColumns(
            {
                "basis": pick("charge_type", default_basis, "qty"),
                "cost_stage": pick("charge_type", stage, "period"),
                "one": F.lit(1),
            }
        )
        .join(known, "basis", "left")
        .join(F.broadcast(fallback.withColumn("one", F.lit(1))), "one", "left")
        .select(
            "scenario", "charge_type", "cost_stage", "unit_price", "basis",
            F.coalesce("basis_qty", "any_qty").alias("basis_qty"),
            (F.col("unit_price") * F.coalesce("basis_qty", "any_qty")).alias("estimate"),
        )
    )


def scenario_summary(estimates: DataFrame, totals: DataFrame) -> DataFrame:
    """Total per scenario, per order, per piece and over revenue."""
    def total(basis: str) -> Column:
        return F.max(F.when(F.col("basis") == basis, F.col("basis_qty")))

    wide = totals.agg(
        total("order_count").alias("orders"),
        total("qty").alias("pieces"),
        total("revenue").alias("revenue"),
    ).withColumn("one", F.lit(1))
    return (
        estimates.groupBy("scenario")
        .agg(F.sum("estimate").alias("total_cost"))
        .withColumn("one", F.lit(1))
        .join(F.broadcast(wide), "one")
        .select(
            "scenario", "total_cost",
            ratio("total_cost", "orders").alias("cost_per_order"),
            ratio("total_cost", "pieces").alias("cost_per_piece"),
            ratio("total_cost", "revenue").alias("cost_to_revenue"),
        )
    )


def scenario_stages(estimates: DataFrame) -> DataFrame:
    """Share of each cost stage in its scenario."""
    stages = estimates.groupBy("scenario", "cost_stage").agg(F.sum("estimate").alias("cost"))
    whole = estimates.groupBy("scenario").agg(F.sum("estimate").alias("total"))
    return stages.join(whole, "scenario").select(
        "scenario", "cost_stage", "cost", ratio("cost", "total").alias("share")
    )


def scenario_top(estimates: DataFrame, n: int = 5) -> DataFrame:
    """The n most expensive charge types of each scenario, from a policy of 18 types."""
    entry = F.struct((-F.col("estimate")).alias("cost"), "charge_type")
    top = estimates.groupBy("scenario").agg(
        F.slice(F.array_sort(F.collect_list(entry)), 1, n).alias("top")
    )
    return top.select("scenario", F.posexplode("top").alias("pos", "t")).select(
        "scenario",
        (F.col("pos") + 1).alias("rank"),
        F.col("t.charge_type").alias("charge_type"),
        (-F.col("t.cost")).alias("estimate"),
    )

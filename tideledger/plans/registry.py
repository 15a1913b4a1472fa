"""Registered queries: one per operator, over the facts of a Parquet order book."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideledger.functions.columns import month_key
from tideledger.operators.asof import asof_join, latest_version
from tideledger.operators.staging import staged
from tideledger.operators.upsert import upsert, without_batches
from tideledger.plans import (
    allocation, boards, constraint, coverage, expiry, pnl, quality, reco, scm,
)
from tideledger.plans.marts import Marts
from tideledger.plans.periods import OnePeriod, periods
from tideledger.session import tune
from tideledger.sources.inbox import cast_columns
from tideledger.sources.order_book import AS_OF_DATE, OrderBook

Query = Callable[[SparkSession, str], DataFrame]

# Lower limits than the defaults where the sample data never reaches them.
LIMITS = {"backlog_orders": 30, "return_rate": 0.01}
# Periods before this one are treated as closed.
CLOSED_BEFORE = "1996-01"

# The period that the boards are shown for, beside all periods.
PERIOD = "1997-03"
PERIOD_BOARDS = [
    "q08_shipment_kpis", "q08_shipments_by_warehouse", "q08_shipments_by_channel",
    "q12_return_kpis", "q12_returns_by_reason", "q12_returns_by_disposition",
    "q12_top_return_items", "q22_revenue_kpis", "q22_revenue_by_store", "q23_coverage_totals",
    "q24_mean_margins", "q25_cost_by_domain", "q25_cost_by_stage", "q26_logistics_ratio",
    "q27_unit_costs", "q28_item_ranking", "q28_store_ranking",
]

MART_QUERIES = {
    "m01_inventory_onhand": "mart_inventory_onhand",
    "m02_open_po": "mart_open_po",
    "m03_stockout_risk": "mart_stockout_risk",
    "m04_overstock": "mart_overstock",
    "m05_expiry_risk": "mart_expiry_risk",
    "m06_fefo_pick_list": "mart_fefo_pick_list",
    "m07_service_level": "mart_service_level",
    "m08_shipment_performance": "mart_shipment_performance",
    "m09_shipment_daily": "mart_shipment_daily",
    "m10_return_analysis": "mart_return_analysis",
    "m11_return_daily": "mart_return_daily",
    "a1_charge_allocated": "mart_charge_allocated",
    "p1_pnl_revenue": "mart_pnl_revenue",
    "p2_pnl_cogs": "mart_pnl_cogs",
    "p3_pnl_gross_margin": "mart_pnl_gross_margin",
    "p4_pnl_variable_cost": "mart_pnl_variable_cost",
    "p5_pnl_contribution": "mart_pnl_contribution",
    "p6_pnl_operating_profit": "mart_pnl_operating_profit",
    "p7_pnl_waterfall_summary": "mart_pnl_waterfall_summary",
    "r1_inventory_movement": "mart_reco_inventory_movement",
    "r2_oms_vs_wms": "mart_reco_oms_vs_wms",
    "r3_erp_vs_wms_receipt": "mart_reco_erp_gr_vs_wms_receipt",
    "r4_settlement_vs_estimated": "mart_reco_settlement_vs_estimated",
    "r5_charges_invoice_vs_allocated": "mart_reco_charges_invoice_vs_allocated",
    "c7_constraint_signals": "mart_constraint_signals",
    "c8_root_cause": "mart_constraint_root_cause",
    "c9_action_plan": "mart_constraint_action_plan",
    "v2_coverage_period": "mart_coverage_period",
}


_facts: dict[tuple[str, str], OrderBook] = {}
_built: dict[tuple[str, str], Marts] = {}


def stored_facts(spark: SparkSession, folder: str) -> OrderBook:
    """The facts of a folder, stored on first use and shared by the queries of a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _facts:
        _facts[key] = OrderBook(tune(spark), folder, keep=staged)
    return _facts[key]


def marts(spark: SparkSession, folder: str) -> Marts:
    """The marts of a folder. Queries of one session share the marts stored on the way."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _built:
        facts = stored_facts(spark, folder)
        closed = (
            facts.exchange_rate.select("period")
            .distinct()
            .where(F.col("period") < CLOSED_BEFORE)
        )
        _built[key] = Marts(facts, AS_OF_DATE, closed, keep=staged, **LIMITS)
    return _built[key]


def forget() -> None:
    """Drop shared marts, so that the next query builds everything itself."""
    _built.clear()


def _mart(attribute: str) -> Query:
    return lambda spark, folder: getattr(marts(spark, folder), attribute)


def _query(build: Callable[[Marts], DataFrame], digits: int = 6, inexact: str = "") -> Query:
    """A query over the marts, of one period if that is named. Sums of fractions depend on the order
    of addition in their last digits, so the ``inexact`` columns are shown rounded."""

    def run(spark: SparkSession, folder: str, period: str | None = None) -> DataFrame:
        m = marts(spark, folder)
        df = build(m if period is None else OnePeriod(m, period))
        return df.withColumns({c: F.round(c, digits) for c in inexact.split()})

    return run


# ---- inputs derived from the facts for single operators ---------------------------------


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def raw_order_files(m: Marts) -> DataFrame:
    """Order lines as the text columns of five files, with faults put in by rule."""
    n = F.col("l_partkey") + F.col("l_suppkey")
    day = F.date_format("order_date", "yyyy-MM-dd")
    return m.facts.lines.select(
        F.lit("OMS").alias("source_system"),
        F.when(n % 101 != 0, _text("l_orderkey")).alias("channel_order_id"),
        F.when(n % 53 == 0, F.concat(F.lit("L"), _text("l_linenumber")))
        .otherwise(_text("l_linenumber"))
        .alias("line_no"),
        F.when(n % 67 == 0, F.lit("soon")).otherwise(day).alias("order_date"),
        F.col("c_mktsegment").alias("channel_store_id"),
        _text("l_partkey").alias("item_id"),
        F.when(n % 31 == 0, F.lit("many"))
        .otherwise(_text(F.col("l_quantity").cast("bigint")))
        .alias("qty_ordered"),
        F.concat(F.lit("orders_"), F.col("c_mktsegment"), F.lit(".csv")).alias("file_name"),
    )


def upserted_orders(m: Marts) -> DataFrame:
    """Order lines after a correction file that changes the returned ones."""
    lines, order = m.facts.lines, m.facts.order
    changed = lines.where(F.col("l_returnflag") == "R").select(
        _text("l_orderkey").alias("channel_order_id"),
        "line_no",
        "order_date",
        F.lit("CORRECTED").alias("channel_store_id"),
        _text("l_partkey").alias("item_id"),
        (F.col("l_quantity") + 100).alias("qty_ordered"),
    )
    return upsert(order, changed, ["channel_order_id", "line_no"])


def rolled_back_orders(m: Marts) -> DataFrame:
    """Order lines without the batches of two years, each year being one batch."""
    batched = m.facts.order.withColumn("load_batch_id", F.year("order_date").cast("bigint"))
    return without_batches(batched, [2000, 2001])


def closed_order_months(m: Marts) -> DataFrame:
    """Incoming order lines that a closed period rejects, per period."""
    incoming = m.facts.order.groupBy(month_key("order_date").alias("period")).agg(
        F.count(F.lit(1)).alias("rejected_rows")
    )
    return incoming.join(m.closed, "period", "left_semi")


def order_line_shares(m: Marts) -> DataFrame:
    """Order totals split over the order's lines by quantity, in whole units."""
    totals = m.facts.table("orders").select("o_orderkey", "o_totalprice")
    qty = m.facts.lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    lines = m.facts.lines.select("l_orderkey", "line_no", "l_quantity")
    shares = (
        lines.join(qty, "l_orderkey")
        .join(totals, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("raw", F.col("l_quantity") / F.col("qty") * F.col("o_totalprice"))
    )
    return allocation.largest_remainder(
        shares, ["l_orderkey"], "line_no", "raw", "o_totalprice"
    ).select("l_orderkey", "line_no", F.col("rounded").alias("allocated"))


def allocation_balance(m: Marts) -> DataFrame:
    """Allocated total of each charge."""
    return m.charge_totals.select(
        *allocation.CHARGE, F.col("allocated_amount").alias("allocated_total"), "targets"
    )


def resolved_bases(m: Marts) -> DataFrame:
    f = m.facts
    totals = allocation.scope_totals(allocation.allocation_targets(f.shipment))
    return allocation.scoped_charges(f.charge, f.exchange_rate, totals).select(
        *allocation.CHARGE, "allocation_basis", "rate",
        F.when(F.col("scope") != allocation.EVERYWHERE, F.col("scope")).alias("warehouse_scope"),
    )


def resolved_issues(m: Marts) -> DataFrame:
    """Critical signals as an issue log in which the supply issues are resolved."""
    resolved = F.when(F.col("domain") == "supply", F.lit("2001-12-31").cast("timestamp"))
    return constraint.signal_issues(m.stored_signals).withColumn("resolved_at", resolved)


def order_cost(m: Marts) -> DataFrame:
    """Order lines with the unit cost in force on the order date, where there is one."""
    return asof_join(
        m.facts.order.select("channel_order_id", "line_no", "item_id", "order_date"),
        scm.unit_costs(m.facts.cost), ["item_id"], "order_date", "effective_from",
        ["unit_cost_krw"], how="inner",
    )


def fact_counts(m: Marts) -> DataFrame:
    facts = {
        "fact_order": m.facts.order, "fact_shipment": m.facts.shipment,
        "fact_return": m.facts.returns, "fact_inventory_snapshot": m.facts.inventory,
        "fact_po": m.facts.po, "fact_receipt": m.facts.receipt,
        "fact_settlement": m.facts.settlement, "fact_charge_actual": m.facts.charge,
        "fact_exchange_rate": m.facts.exchange_rate, "fact_cost_structure": m.facts.cost,
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "*")
        for n, df in facts.items()
    ]
    return boards.stack(*counts)


def scenario_prices(m: Marts) -> DataFrame:
    """Unit prices per charge type, one scenario per invoice currency."""
    return m.facts.charge.groupBy(F.col("currency").alias("scenario"), "charge_type").agg(
        F.floor(F.min("amount") / 1000).cast("double").alias("unit_price")
    )


def _estimates(m: Marts) -> tuple[DataFrame, DataFrame]:
    f = m.facts
    totals = boards.basis_totals(f.order, f.shipment, f.inventory, f.item, m.mart_pnl_revenue)
    return boards.scenario_costs(scenario_prices(m), totals), totals


OPERATOR_QUERIES: dict[str, Query] = {
    "e1_final_expiry": _query(lambda m: m.lot_state.select(
        "snapshot_date", "warehouse_id", "item_id", "lot_id", "item_type", "final_expiry_date",
        F.col("effective_min_sellable_days").alias("min_days"))),
    "e2_sellable_qty": _query(lambda m: m.lot_state.select(
        "snapshot_date", "warehouse_id", "item_id", "lot_id", "onhand_qty", "expired_qty",
        "blocked_qty", "sellable_qty")),
    "e3_fefo_rank": _query(lambda m: expiry.fefo_rank(m.lot_state).select(
        "snapshot_date", "warehouse_id", "item_id", "lot_id", "fefo_rank")),
    "e4_expiry_bucket": _query(lambda m: m.lot_state.select(
        "snapshot_date", "warehouse_id", "item_id", "lot_id", "days_to_expiry",
        "expiry_bucket")),
    "e5_expired_issues": _query(lambda m: expiry.expired_issues(m.lot_state)),
    "a2_resolved_basis": _query(resolved_bases),
    "a4_allocation_balance": _query(allocation_balance),
    "a5_largest_remainder": _query(order_line_shares),
    "a6_unallocated_charges": _query(lambda m: allocation.unallocated_charges(
        m.facts.charge, m.facts.exchange_rate, m.facts.shipment)),
    "c1_late_po": _query(lambda m: constraint.late_po(m.facts.po, m.facts.receipt, AS_OF_DATE)),
    "c2_supplier_delay": _query(lambda m: constraint.supplier_delay(m.facts.po, m.facts.receipt)),
    "c3_backlog": _query(lambda m: constraint.backlog(
        m.facts.order, m.facts.shipment, LIMITS["backlog_orders"])),
    "c4_dwell_time": _query(lambda m: constraint.dwell_time(m.facts.po, m.facts.receipt)),
    "c5_return_spike": _query(lambda m: constraint.return_spike(
        m.facts.returns, m.facts.shipment, LIMITS["return_rate"])),
    "c6_expired_stock": _query(lambda m: constraint.expired_stock(m.lot_state)),
    "c10_effectiveness": _query(lambda m: constraint.effectiveness(
        resolved_issues(m), m.stored_signals)),
    "v1_domain_rows": _query(lambda m: m.domain_rows),
    "v3_closed_period_gaps": _query(
        lambda m: coverage.closed_period_gaps(m.closed, m.domain_rows)),
    "d03_duplicate_keys": _query(lambda m: quality.duplicate_keys(
        raw_order_files(m), "fact_order", ["channel_order_id", "line_no"], "file_name")),
    "d06_quality_results": _query(lambda m: quality.check_files(
        raw_order_files(m), "fact_order").drop("detail")),
    "d07_failed_files": _query(lambda m: quality.failed_files(
        quality.check_files(raw_order_files(m), "fact_order"))),
    "d08_duplicate_grain": _query(
        lambda m: pnl.duplicate_grain(m.mart_pnl_revenue, pnl.GRAIN)),
    "j06_asof_order_cost": _query(order_cost),
    "j07_latest_cost": _query(lambda m: latest_version(
        scm.unit_costs(m.facts.cost), ["item_id"], "effective_from", ["unit_cost_krw"])),
    "o07_closed_period_gate": _query(closed_order_months),
    "o08_coverage_gaps": _query(lambda m: boards.for_period(m.mart_coverage_period, None)
                                .where(F.col("severity") != "OK")
                                .orderBy("severity", "domain", "period").limit(10)
                                .select("domain", "period", "coverage_rate", "severity")),
    "r5_untied_charges": _query(lambda m: reco.untied_charges(
        m.mart_reco_charges_invoice_vs_allocated)),
    "s09_cast_columns": _query(lambda m: cast_columns(raw_order_files(m), "fact_order")),
    "s12_upsert": _query(upserted_orders),
    "s20_rollback": _query(rolled_back_orders),
    "s22_row_counts": _query(fact_counts),
}

BOARD_QUERIES: dict[str, Query] = {
    "q01_inventory_kpis": _query(lambda m: boards.inventory_kpis(m.lot_state)),
    "q02_inventory_value": _query(lambda m: boards.inventory_value(m.lot_state, m.facts.cost)),
    "q03_inventory_by_warehouse_type": _query(
        lambda m: boards.inventory_by_warehouse_type(m.lot_state, m.facts.warehouse)),
    "q04_onhand_by_bucket": _query(lambda m: boards.onhand_by_bucket(m.lot_state)),
    "q05_po_kpis": _query(lambda m: boards.po_kpis(m.mart_open_po)),
    "q06_eta_accuracy": _query(lambda m: boards.eta_accuracy(m.mart_open_po)),
    "q07_lead_time_by_supplier": _query(lambda m: boards.lead_time_by_supplier(m.mart_open_po)),
    "q08_shipment_kpis": _query(lambda m: boards.shipment_kpis(m.mart_shipment_performance),
                                inexact="avg_on_time_pct avg_lead_days"),
    "q08_shipments_by_warehouse": _query(
        lambda m: boards.shipments_by(m.mart_shipment_performance, "warehouse_id"),
        inexact="avg_on_time_pct"),
    "q08_shipments_by_channel": _query(
        lambda m: boards.shipments_by(m.mart_shipment_performance, "channel_store_id"),
        inexact="avg_on_time_pct"),
    "q09_backlog": _query(lambda m: boards.backlog_totals(m.facts.order, m.facts.shipment)),
    "q10_matching_rates": _query(
        lambda m: boards.matching_rates(m.facts.order, m.facts.shipment)),
    "q11_shipment_trend": _query(lambda m: boards.daily_totals(
        m.mart_shipment_daily, "ship_date", "shipment_count", "qty_shipped")),
    "q11_return_trend": _query(lambda m: boards.daily_totals(
        m.mart_return_daily, "return_date", "return_count", "qty_returned")),
    "q12_return_kpis": _query(lambda m: boards.return_kpis(m.mart_return_analysis)),
    "q12_returns_by_reason": _query(lambda m: boards.returns_by(m.mart_return_analysis, "reason")),
    "q12_returns_by_disposition": _query(
        lambda m: boards.returns_by(m.mart_return_analysis, "disposition")),
    "q12_top_return_items": _query(lambda m: boards.top_return_items(m.mart_return_analysis)),
    "q13_stockout_count": _query(
        lambda m: boards.flagged_count(m.mart_stockout_risk, "risk_flag")),
    "q13_overstock_count": _query(
        lambda m: boards.flagged_count(m.mart_overstock, "overstock_flag")),
    "q14_turnover_kpis": _query(lambda m: boards.turnover_kpis(
        boards.turnover(m.lot_state, m.facts.shipment)), inexact="avg_turnover"),
    "q14_slowest_items": _query(lambda m: boards.slowest_items(
        boards.turnover(m.lot_state, m.facts.shipment))),
    "q15_overstock_value": _query(lambda m: boards.overstock_value_kpis(
        boards.overstock_value(m.mart_overstock, m.facts.cost)), 0, "overstock_value"),
    "q15_top_overstock": _query(lambda m: boards.top_overstock(
        boards.overstock_value(m.mart_overstock, m.facts.cost))),
    "q16_expiry_kpis": _query(lambda m: boards.expiry_kpis(m.mart_expiry_risk)),
    "q16_expiry_buckets": _query(lambda m: boards.expiry_buckets(m.mart_expiry_risk)),
    "q17_fefo_top": _query(lambda m: boards.fefo_top(m.mart_fefo_pick_list)),
    "q18_service_level": _query(lambda m: boards.service_level_mean(m.mart_service_level),
                                inexact="avg_service_level"),
    "q18_service_level_series": _query(
        lambda m: boards.service_level_series(m.mart_service_level)),
    "q19_signal_counts": _query(lambda m: boards.signal_counts(m.mart_constraint_signals)),
    "q19_resolved_share": _query(lambda m: boards.resolved_share(constraint.effectiveness(
        resolved_issues(m), m.stored_signals))),
    "q20_reco_summary": _query(lambda m: boards.reco_summary(
        m.mart_reco_inventory_movement, m.mart_reco_oms_vs_wms,
        m.mart_reco_erp_gr_vs_wms_receipt, m.mart_reco_settlement_vs_estimated,
        m.mart_reco_charges_invoice_vs_allocated), inexact="mean_rate"),
    "q21_waterfall": _query(lambda m: boards.waterfall(m.mart_pnl_waterfall_summary, "1997-03")),
    "q22_revenue_kpis": _query(lambda m: boards.revenue_kpis(m.mart_pnl_revenue)),
    "q22_revenue_by_store": _query(lambda m: boards.revenue_by_store(m.mart_pnl_revenue)),
    "q23_coverage_totals": _query(lambda m: boards.stack(
        boards.coverage_totals(m.mart_pnl_cogs, "cogs_krw", "cogs"),
        boards.coverage_totals(m.mart_pnl_gross_margin, "gross_margin_krw", "gross_margin"),
        boards.coverage_totals(m.mart_pnl_contribution, "contribution_krw", "contribution"))),
    "q24_mean_margins": _query(lambda m: boards.stack(
        boards.mean_over_actual(m.mart_pnl_gross_margin, "gross_margin_pct", "gross_margin"),
        boards.mean_over_actual(m.mart_pnl_contribution, "contribution_pct", "contribution"),
        boards.mean_over_actual(
            m.mart_pnl_operating_profit, "operating_profit_pct", "operating_profit")),
        inexact="avg_pct"),
    "q25_cost_by_domain": _query(
        lambda m: boards.amount_by(m.charge_totals, "charge_domain")),
    "q25_cost_by_stage": _query(lambda m: boards.amount_by(m.charge_totals, "cost_stage")),
    "q26_logistics_ratio": _query(
        lambda m: boards.logistics_ratio(m.charge_totals, m.mart_pnl_revenue)),
    "q27_unit_costs": _query(
        lambda m: boards.unit_costs_per_sale(m.charge_totals, m.facts.shipment)),
    "q28_item_ranking": _query(lambda m: boards.best_and_worst(
        boards.profitability(m.mart_pnl_contribution, "item_id"), "item_id"),
        inexact="contribution_pct"),
    "q28_store_ranking": _query(lambda m: boards.best_and_worst(
        boards.profitability(m.mart_pnl_contribution, "channel_store_id"), "channel_store_id"),
        inexact="contribution_pct"),
    "q29_coverage_counts": _query(lambda m: boards.coverage_counts(m.mart_coverage_period)),
    "q30_fx_coverage": _query(
        lambda m: boards.fx_coverage(m.facts.settlement, m.facts.exchange_rate)),
    "q31_coverage_flags": _query(lambda m: boards.coverage_flags({
        "revenue": m.mart_pnl_revenue, "cogs": m.mart_pnl_cogs,
        "gross_margin": m.mart_pnl_gross_margin, "variable_cost": m.mart_pnl_variable_cost,
        "contribution": m.mart_pnl_contribution,
        "operating_profit": m.mart_pnl_operating_profit})),
    "q32_scenario_costs": _query(lambda m: _estimates(m)[0]),
    "q32_scenario_summary": _query(lambda m: boards.scenario_summary(*_estimates(m))),
    "q32_scenario_stages": _query(lambda m: boards.scenario_stages(_estimates(m)[0])),
    "q32_scenario_top": _query(lambda m: boards.scenario_top(_estimates(m)[0])),
    "q33_periods": _query(lambda m: periods(
        m.mart_shipment_performance, m.mart_return_analysis, m.mart_pnl_revenue,
        m.variable_cost_sums, m.mart_pnl_contribution)),
}


def _shown_for(query: Query, period: str) -> Query:
    return lambda spark, folder: query(spark, folder, period=period)


def queries() -> dict[str, Query]:
    plain = {name: _mart(attribute) for name, attribute in MART_QUERIES.items()}
    chosen = {f"{name}_in_period": _shown_for(BOARD_QUERIES[name], PERIOD) for name in PERIOD_BOARDS}
    return {**plain, **OPERATOR_QUERIES, **BOARD_QUERIES, **chosen}

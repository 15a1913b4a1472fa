"""Batch runs, rollback, period close and status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.plans import allocation, constraint, coverage, expiry, pnl, reco
from tideledger.plans.marts import Marts
from tideledger.sources.inbox import ingest
from tideledger.sources.warehouse import Warehouse

# Build order; each group reads what the groups before it stored.
MART_ORDER = [
    "mart_inventory_onhand", "mart_open_po", "mart_stockout_risk", "mart_overstock",
    "mart_expiry_risk", "mart_fefo_pick_list", "mart_service_level",
    "mart_shipment_performance", "mart_shipment_daily", "mart_return_analysis",
    "mart_return_daily",
    "mart_charge_allocated",
    "mart_pnl_revenue", "mart_pnl_cogs", "mart_pnl_gross_margin", "mart_pnl_variable_cost",
    "mart_pnl_contribution", "mart_pnl_operating_profit", "mart_pnl_waterfall_summary",
    "mart_reco_inventory_movement", "mart_reco_oms_vs_wms", "mart_reco_erp_gr_vs_wms_receipt",
    "mart_reco_settlement_vs_estimated", "mart_reco_charges_invoice_vs_allocated",
    "mart_constraint_signals", "mart_constraint_root_cause", "mart_constraint_action_plan",
    "mart_coverage_period",
    "mart_constraint_effectiveness",
]
# Marts that are stored in an order.
SORTED = {"mart_fefo_pick_list": ("warehouse_id", "item_id", "fefo_rank", "lot_id")}

# Marts that boards read by period.
BY_PERIOD = {
    "mart_shipment_performance", "mart_return_analysis", "mart_pnl_revenue", "mart_pnl_cogs",
    "mart_pnl_gross_margin", "mart_pnl_variable_cost", "mart_pnl_contribution",
    "mart_pnl_operating_profit",
}


# ---- batches ----------------------------------------------------------------------------


def start_batch(warehouse: Warehouse) -> int:
    last = warehouse.batch_log().agg(F.coalesce(F.max("batch_id"), F.lit(0))).first()[0]
    batch_id = warehouse.claim("batch", last + 1)
    warehouse.add_entry(
        "raw", "system_batch_log",
        {"batch_id": batch_id, "started_at": True, "status": "running", "logged_at": True},
    )
    return batch_id


def finish_batch(warehouse: Warehouse, batch_id: int, status: str, files: int = 0,
                 rows: int = 0, error: str | None = None) -> None:
    warehouse.add_entry(
        "raw", "system_batch_log",
        {"batch_id": batch_id, "finished_at": True, "status": status, "file_count": files,
         "rows_ingested": rows, "error_msg": error, "logged_at": True},
    )


def build_marts(warehouse: Warehouse, as_of_date: dt.date) -> dict[str, str]:
    """Rebuild all marts in order. A mart that fails is reported and the rest go on."""
    marts = Marts(warehouse, as_of_date, warehouse.closed_periods())
    outcome = {}
    for name in MART_ORDER:
        try:
            if name == "mart_pnl_gross_margin":
                pnl.assert_unique_grain(marts.mart_pnl_cogs, pnl.GRAIN, "mart_pnl_cogs")
            if name == "mart_constraint_effectiveness":
                mart = constraint.effectiveness(warehouse.issue_log(), marts.mart_constraint_signals)
                warehouse.replace("mart", name, mart)
                outcome[name] = "ok"
                continue
            if name == "mart_charge_allocated":
                store_allocation(warehouse, marts)
                outcome[name] = "ok"
                continue
            if name == "mart_reco_charges_invoice_vs_allocated":
                # The factors as stored are what has to add up, not what they should be.
                marts.charge_totals = allocation.spread_totals(marts.charge_spread)
            mart = getattr(marts, name)
            if name in BY_PERIOD:
                warehouse.replace_by_period("mart", name, mart)
            else:
                warehouse.replace("mart", name, mart.orderBy(*SORTED[name]) if name in SORTED else mart)
            # Later marts read the stored table instead of repeating its plan.
            setattr(marts, name, warehouse.read("mart", name).select(*mart.columns))
            if name == "mart_inventory_onhand":
                marts.onhand_for_signals = marts.mart_inventory_onhand
                add_issues(warehouse, expiry.expired_issues(marts.mart_inventory_onhand))
            if name == "mart_constraint_signals":
                add_issues(warehouse, constraint.signal_issues(marts.mart_constraint_signals))
            outcome[name] = "ok"
        except Exception as e:  # noqa: BLE001 - reported per mart, raised by the caller
            outcome[name] = f"{type(e).__name__}: {e}"
    return outcome


def store_allocation(warehouse: Warehouse, marts: Marts) -> None:
    """Store the allocation as a row per charge, per charge and distinct basis value, and per target.
    The mart is a view of these, so what it takes on disk does not grow with charges x shipments."""
    made = marts.charge_spread
    tables = {"mart_charge_factor": made.charges, "mart_charge_part": made.parts,
              "mart_charge_target": made.targets}
    for table, rows in tables.items():
        warehouse.replace("mart", table, rows)
    charges, parts, targets = (warehouse.name("mart", t) for t in tables)
    warehouse.replace_view(
        "mart", "mart_charge_allocated", allocation.expansion_sql(charges, targets, made.factor)
    )
    stored = map(warehouse.spark.table, (charges, parts, targets))
    marts.charge_spread = allocation.Spread(*stored, made.factor)
    marts.mart_charge_allocated = warehouse.read("mart", "mart_charge_allocated")


def add_issues(warehouse: Warehouse, issues: DataFrame) -> None:
    fresh = expiry.new_issues(issues, warehouse.issue_log())
    warehouse.append(
        "ops", "ops_issue_log",
        fresh.withColumns(
            {"created_at": F.current_timestamp(), "resolved_at": F.lit(None).cast("timestamp")}
        ),
    )


def run_pipeline(warehouse: Warehouse, inbox: str, as_of_date: dt.date,
                 dry_run: bool = False, reject_closed: bool = False) -> dict:
    """Ingest the inbox, then rebuild the marts. A dry run writes no fact and no mart."""
    batch_id = start_batch(warehouse)
    try:
        files = ingest(warehouse, inbox, batch_id, dry_run, reject_closed)
        marts = {} if dry_run else build_marts(warehouse, as_of_date)
        failed = {n: r for n, r in marts.items() if r != "ok"}
        if failed:
            raise RuntimeError(f"Marts failed: {failed}")
    except Exception as e:
        finish_batch(warehouse, batch_id, "failed", error=str(e))
        raise
    n, rows = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("row_count"), F.lit(0))).first()
    finish_batch(warehouse, batch_id, "dry_run" if dry_run else "success", n, rows)
    return {"batch_id": batch_id, "files": files, "marts": marts}


def rollback_batches(warehouse: Warehouse, n: int, as_of_date: dt.date) -> list[int]:
    """Remove the rows of the last n batches and rebuild the marts.

    Their files can be loaded again. Rows that a removed batch had replaced do not come back.
    """
    last = warehouse.batch_log().orderBy(F.desc("batch_id")).limit(n).select("batch_id")
    ids = [r[0] for r in last.collect()]
    if not ids:
        return []
    for table in config.CONTRACTS:
        warehouse.remove_batches(table, ids)
    files = warehouse.file_log().where(F.col("batch_id").isin(ids))
    warehouse.append(
        "raw", "system_file_log",
        files.withColumns(
            {"status": F.lit("rolled_back"), "processed_at": F.current_timestamp()}
        ),
    )
    for batch_id in ids:
        finish_batch(warehouse, batch_id, "rolled_back")
    build_marts(warehouse, as_of_date)
    return ids


# ---- period close -----------------------------------------------------------------------


def close_period(warehouse: Warehouse, period: str, closed_by: str) -> None:
    warehouse.add_entry(
        "ops", "ops_period_close",
        {"period": period, "closed_at": True, "closed_by": closed_by, "lock_flag": True,
         "logged_at": True},
    )


def reopen_period(warehouse: Warehouse, period: str, reason: str) -> None:
    if is_period_closed(warehouse, period):
        warehouse.add_entry(
            "ops", "ops_period_close",
            {"period": period, "lock_flag": False, "notes": f"Reopened: {reason}",
             "logged_at": True},
        )


def is_period_closed(warehouse: Warehouse, period: str) -> bool:
    return not warehouse.closed_periods().where(F.col("period") == period).isEmpty()


def closed_periods(warehouse: Warehouse) -> DataFrame:
    return warehouse.closed_periods().orderBy("period")


def check_period_for_ingestion(warehouse: Warehouse, period: str) -> None:
    if is_period_closed(warehouse, period):
        raise ValueError(
            f"Period '{period}' is closed. Record a post-close adjustment or reopen it first."
        )


def post_close_adjustment(
    warehouse: Warehouse, period: str, table_name: str, business_key: str, field_name: str,
    old_value: str | None, new_value: str | None, reason: str, adjusted_by: str,
    batch_id: int | None = None,
) -> int:
    """Append an audit row and return its id."""
    log = warehouse.read("ops", "ops_adjustment_log")
    last = log.agg(F.coalesce(F.max("adjustment_id"), F.lit(0))).first()[0]
    number = warehouse.claim("adjustment", last + 1)
    warehouse.add_entry(
        "ops", "ops_adjustment_log",
        {"adjustment_id": number, "period": period, "table_name": table_name,
         "business_key": business_key, "field_name": field_name, "old_value": old_value,
         "new_value": new_value, "reason": reason, "adjusted_by": adjusted_by,
         "batch_id": batch_id, "adjusted_at": True},
    )
    return number


def adjustments(warehouse: Warehouse, period: str) -> DataFrame:
    log = warehouse.read("ops", "ops_adjustment_log")
    return log.where(F.col("period") == period).orderBy("adjustment_id")


def closed_period_errors(warehouse: Warehouse, period: str) -> DataFrame:
    """What a closed period still lacks."""
    rows = Marts(warehouse, dt.date.min).domain_rows
    one = warehouse.spark.createDataFrame([(period,)], "period string")
    return coverage.closed_period_gaps(one, rows)


# ---- status -----------------------------------------------------------------------------


def last_batch(warehouse: Warehouse) -> DataFrame:
    return warehouse.batch_log().orderBy(F.desc("batch_id")).limit(1)


def last_failures(warehouse: Warehouse, n: int = 5) -> DataFrame:
    report = warehouse.read("raw", "system_dq_report").where(~F.col("passed"))
    return report.orderBy(F.desc("checked_at")).limit(n).select("check_name", "severity", "detail")


def coverage_gaps(coverage_mart: DataFrame, n: int = 10) -> DataFrame:
    return (
        coverage_mart.where(F.col("severity") != "OK")
        .orderBy("severity", "domain", "period")
        .limit(n)
        .select("domain", "period", "coverage_rate", "severity")
    )


def seed_charge_policy(warehouse: Warehouse) -> None:
    policy = allocation.charge_policy(warehouse.spark).drop("basis_priority")
    warehouse.replace("core", "dim_charge_policy", policy)


def untied_charge_issues(warehouse: Warehouse) -> DataFrame:
    """Invoice totals that the stored allocation does not reach."""
    return reco.untied_charges(warehouse.read("mart", "mart_reco_charges_invoice_vs_allocated"))

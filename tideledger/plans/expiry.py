"""Lot expiry: shelf-life state, sellable quantity, picking order, buckets, issues."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import bucket_label, or_zero, pick, stable_id
from tideledger.operators.ranking import ordered_position

LAST_DAY = dt.date.max


def lot_expiry(snapshot: DataFrame, item: DataFrame) -> DataFrame:
    """Snapshot lots with their item's type, QC need and minimum days left to be sellable."""
    facts = item.select("item_id", "item_type", "min_sellable_days", "qc_required_flag")
    default_days = pick("item_type", config.MIN_SELLABLE_DAYS, config.MIN_SELLABLE_DAYS_DEFAULT)
    return snapshot.join(facts, "item_id", "left").withColumns(
        {
            "final_expiry_date": F.col("expiry_date"),
            "effective_min_sellable_days": F.coalesce(
                F.col("min_sellable_days"), default_days
            ).cast("int"),
        }
    )


def sellable_quantity(lots: DataFrame) -> DataFrame:
    """Split on-hand into expired and blocked quantity; the rest, never negative, is sellable."""
    expiry, day = F.col("final_expiry_date"), F.col("snapshot_date")
    expired = expiry < day
    too_short = (expiry < F.date_add(day, F.col("effective_min_sellable_days"))) & (expiry >= day)
    needs_qc = F.coalesce(F.col("qc_required_flag"), F.lit(False)) & (
        F.lower(F.coalesce(F.col("qc_status"), F.lit(""))) != "released"
    )
    blocked = F.col("hold_flag") | needs_qc | (expiry.isNotNull() & too_short)
    onhand = F.col("onhand_qty")
    return lots.withColumns(
        {
            "expired_qty": F.when(expiry.isNotNull() & expired, onhand).otherwise(F.lit(0.0)),
            "blocked_qty": F.when(blocked, onhand).otherwise(F.lit(0.0)),
        }
    ).withColumn(
        "sellable_qty",
        F.greatest(onhand - F.col("expired_qty") - F.col("blocked_qty"), F.lit(0.0)),
    )


def fefo_rank(lots: DataFrame) -> DataFrame:
    """First-expired-first-out rank within warehouse and item; lots without expiry get NULL.

    Ties are ordered by lot, then snapshot day. The rank spans all snapshots of an item, so a
    group can be large; it is numbered by counting rather than by sorting the group.
    """
    expires = F.col("final_expiry_date")
    # Undated lots sort behind all dates and so leave the other ranks alone.
    placed = ordered_position(
        lots.withColumn("__expires", F.coalesce(expires, F.lit(LAST_DAY))),
        ["warehouse_id", "item_id"], ["__expires"], ["lot_id", "snapshot_date"], "fefo_rank",
    )
    rank = F.when(expires.isNotNull(), F.col("fefo_rank").cast("int"))
    return placed.withColumn("fefo_rank", rank).drop("__expires")


def expiry_bucket(lots: DataFrame, edges: list[int] = config.EXPIRY_BUCKETS) -> DataFrame:
    days = F.datediff("final_expiry_date", "snapshot_date")
    return lots.withColumn("days_to_expiry", days.cast("int")).withColumn(
        "expiry_bucket", bucket_label("days_to_expiry", edges)
    )


def expired_issues(lots: DataFrame) -> DataFrame:
    """One CRITICAL issue per lot row that holds expired stock."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("item_id", "lot_id", "warehouse_id")]
    entity = F.concat_ws("|", *parts)
    day = F.col("snapshot_date").cast("string")
    detail = F.concat(
        F.lit("Expired stock: item="), F.coalesce("item_id", F.lit("None")),
        F.lit(", lot="), F.coalesce("lot_id", F.lit("None")),
        F.lit(", warehouse="), F.coalesce("warehouse_id", F.lit("None")),
        F.lit(", qty="), F.col("expired_qty").cast("string"),
        F.lit(", expiry="), F.col("final_expiry_date").cast("string"),
    )
    return lots.where(or_zero("expired_qty") > 0).select(
        stable_id("EXP-", entity, day).alias("issue_id"),
        F.lit("EXPIRED_STOCK").alias("issue_type"),
        F.lit("CRITICAL").alias("severity"),
        F.lit("expiry").alias("domain"),
        F.lit("item_lot").alias("entity_type"),
        entity.alias("entity_id"),
        F.coalesce(day, F.lit("")).alias("period"),
        detail.alias("detail"),
    )


def new_issues(candidates: DataFrame, issue_log: DataFrame) -> DataFrame:
    """Issues not in the log yet; ids are stable, so a rerun adds nothing."""
    return candidates.join(issue_log.select("issue_id"), "issue_id", "left_anti")

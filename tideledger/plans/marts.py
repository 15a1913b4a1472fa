"""All marts over one set of facts, each a lazy DataFrame built on first use.

``facts`` is any object with the attributes order, shipment, returns, inventory, item, po,
receipt, settlement, exchange_rate, cost and charge: the Parquet order book or the warehouse.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.plans import allocation, constraint, coverage, pnl, reco, scm


class Marts:
    def __init__(
        self,
        facts,
        as_of_date: dt.date,
        closed: DataFrame | None = None,
        keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
        **limits,
    ):
        """``keep`` is applied to marts that later marts read, to store them first."""
        self.facts = facts
        self.as_of_date = as_of_date
        self.closed = closed
        self.keep = keep
        self.limits = limits

    # Supply chain
    @cached_property
    def mart_inventory_onhand(self) -> DataFrame:
        return scm.inventory_onhand(self.facts.inventory, self.facts.item)

    @cached_property
    def lot_state(self) -> DataFrame:
        return scm.lot_state(self.facts.inventory, self.facts.item)

    @cached_property
    def mart_open_po(self) -> DataFrame:
        return scm.open_po(self.facts.po, self.facts.receipt, self.as_of_date)

    @cached_property
    def mart_stockout_risk(self) -> DataFrame:
        f = self.facts
        return scm.stockout_risk(f.inventory, f.item, f.shipment)

    @cached_property
    def mart_overstock(self) -> DataFrame:
        f = self.facts
        return scm.overstock(f.inventory, f.item, f.shipment)

    @cached_property
    def mart_expiry_risk(self) -> DataFrame:
        f = self.facts
        return scm.expiry_risk(f.inventory, f.item, f.cost)

    @cached_property
    def mart_fefo_pick_list(self) -> DataFrame:
        return scm.fefo_pick_list(self.facts.inventory, self.facts.item)

    @cached_property
    def mart_service_level(self) -> DataFrame:
        return scm.service_level(self.facts.order, self.facts.shipment)

    @cached_property
    def mart_shipment_performance(self) -> DataFrame:
        return scm.shipment_performance(self.facts.shipment, self.facts.order)

    @cached_property
    def mart_shipment_daily(self) -> DataFrame:
        return scm.shipment_daily(self.facts.shipment)

    @cached_property
    def mart_return_analysis(self) -> DataFrame:
        f = self.facts
        return scm.return_analysis(f.returns, f.order, f.shipment)

    @cached_property
    def mart_return_daily(self) -> DataFrame:
        return scm.return_daily(self.facts.returns)

    # Allocation
    @cached_property
    def charge_spread(self) -> allocation.Spread:
        """The allocation as factors, made once for the mart and for sums of it."""
        f = self.facts
        return allocation.spread_charges(f.charge, f.exchange_rate, f.shipment)

    @cached_property
    def mart_charge_allocated(self) -> DataFrame:
        return allocation.expanded(self.charge_spread)

    @cached_property
    def charge_totals(self) -> DataFrame:
        """The allocated mart summed per charge, without its rows."""
        f = self.facts
        return allocation.charge_totals(f.charge, f.exchange_rate, f.shipment)

    # Profit and loss
    @cached_property
    def mart_pnl_revenue(self) -> DataFrame:
        f = self.facts
        store = getattr(f, "channel_store", None)
        return pnl.revenue(f.settlement, f.exchange_rate, store)

    @cached_property
    def mart_pnl_cogs(self) -> DataFrame:
        f = self.facts
        return self.keep(pnl.cogs(f.shipment, f.returns, f.cost), "mart_pnl_cogs")

    @cached_property
    def mart_pnl_gross_margin(self) -> DataFrame:
        margin = pnl.gross_margin(self.mart_pnl_revenue, self.mart_pnl_cogs)
        return self.keep(margin, "mart_pnl_gross_margin")

    @cached_property
    def mart_pnl_variable_cost(self) -> DataFrame:
        """As long as the charge-target pairs where items and stores are many, so it is not stored
        for other marts: they read ``variable_cost_sums`` and the costs of the grains they have."""
        sums = allocation.allocated_sums(
            self.charge_spread, ["period", "charge_domain", "charge_type"],
            ["item_id", "channel_store_id"],
        )
        return pnl.variable_cost(sums)

    @cached_property
    def variable_cost_sums(self) -> DataFrame:
        """The variable cost mart summed over items and stores, without its rows."""
        sums = allocation.allocated_sums(self.charge_spread, ["period", "charge_domain", "charge_type"], [])
        none = F.lit(None).cast("string")
        sums = pnl.variable_cost(sums.withColumns({"item_id": none, "channel_store_id": none}))
        return self.keep(sums, "variable-cost-sums")

    @cached_property
    def mart_pnl_contribution(self) -> DataFrame:
        margin = self.mart_pnl_gross_margin
        costs = allocation.allocated_sums(
            self.charge_spread, ["period"], ["item_id", "channel_store_id"], only=margin
        )
        left_over = pnl.contribution(margin, costs)
        return self.keep(left_over, "mart_pnl_contribution")

    @cached_property
    def mart_pnl_operating_profit(self) -> DataFrame:
        return pnl.operating_profit(self.mart_pnl_contribution)

    @cached_property
    def mart_pnl_waterfall_summary(self) -> DataFrame:
        return pnl.waterfall_summary(
            self.mart_pnl_revenue,
            self.mart_pnl_cogs,
            self.mart_pnl_gross_margin,
            self.variable_cost_sums,
            self.mart_pnl_contribution,
            self.mart_pnl_operating_profit,
        )

    # Reconciliation
    @cached_property
    def mart_reco_inventory_movement(self) -> DataFrame:
        f = self.facts
        return reco.inventory_movement(f.inventory, f.receipt, f.shipment, f.returns)

    @cached_property
    def mart_reco_oms_vs_wms(self) -> DataFrame:
        return reco.oms_vs_wms(self.facts.order, self.facts.shipment)

    @cached_property
    def mart_reco_erp_gr_vs_wms_receipt(self) -> DataFrame:
        return reco.erp_vs_wms_receipt(self.facts.receipt)

    @cached_property
    def mart_reco_settlement_vs_estimated(self) -> DataFrame:
        f = self.facts
        return reco.settlement_vs_estimated(f.settlement, f.exchange_rate, self.mart_pnl_revenue)

    @cached_property
    def mart_reco_charges_invoice_vs_allocated(self) -> DataFrame:
        return reco.charges_invoice_vs_allocated(self.facts.charge, self.charge_totals)

    # Constraints
    @cached_property
    def mart_constraint_signals(self) -> DataFrame:
        f = self.facts
        return constraint.constraint_signals(
            f.order, f.shipment, f.returns, f.po, f.receipt,
            getattr(self, "onhand_for_signals", self.lot_state),
            self.as_of_date, **self.limits,
        )

    @cached_property
    def stored_signals(self) -> DataFrame:
        """The signals for plans that read them more than once: both readings would build them whole."""
        return self.keep(self.mart_constraint_signals, "constraint-signals")

    @cached_property
    def mart_constraint_root_cause(self) -> DataFrame:
        return constraint.root_causes(self.mart_constraint_signals)

    @cached_property
    def mart_constraint_action_plan(self) -> DataFrame:
        return constraint.action_plan(self.mart_constraint_signals)

    # Coverage
    @cached_property
    def domain_rows(self) -> DataFrame:
        f = self.facts
        return coverage.domain_rows(f.exchange_rate, f.settlement, f.cost, f.charge)

    @cached_property
    def mart_coverage_period(self) -> DataFrame:
        f = self.facts
        periods = coverage.known_periods(f.order, f.shipment, f.charge, f.settlement)
        closed = self.closed
        if closed is None:
            closed = periods.limit(0)
        return coverage.coverage_period(periods, self.domain_rows, closed)

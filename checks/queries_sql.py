"""Oracle SQL per registered query."""

import re

from checks.oracle import with_ctes

MART_SQL = {
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
    "r5_charges_invoice_vs_allocated": "mart_reco_charges",
    "c7_constraint_signals": "mart_constraint_signals",
    "v2_coverage_period": "mart_coverage_period",
}

SQL = {
    "c8_root_cause": """
        SELECT signal_id, root_cause, contributing_factors, domain, period
        FROM mart_constraint_signals JOIN signal_rules USING (metric_name)
        WHERE severity IN ('CRITICAL', 'HIGH')""",
    "c9_action_plan": """
        SELECT signal_id, action, priority, responsible, domain, period
        FROM mart_constraint_signals JOIN signal_rules USING (metric_name)""",
    # ---- single operators ---------------------------------------------------------------
    "e1_final_expiry": """
        SELECT snapshot_date, warehouse_id, item_id, lot_id, item_type, final_expiry_date,
               min_days FROM lot_expiry""",
    "e2_sellable_qty": """
        SELECT snapshot_date, warehouse_id, item_id, lot_id, onhand_qty, expired_qty,
               blocked_qty, sellable_qty FROM lot_state""",
    "e3_fefo_rank": """
        SELECT snapshot_date, warehouse_id, item_id, lot_id, fefo_rank FROM fefo""",
    "e4_expiry_bucket": """
        SELECT snapshot_date, warehouse_id, item_id, lot_id, days_to_expiry, expiry_bucket
        FROM lot_state""",
    "e5_expired_issues": """
        SELECT 'EXP-' || upper(substr(sha256(entity_id || '|' || period), 1, 16)) AS issue_id,
               'EXPIRED_STOCK' AS issue_type, 'CRITICAL' AS severity, 'expiry' AS domain,
               'item_lot' AS entity_type, entity_id, period,
               'Expired stock: item=' || item_id || ', lot=' || lot_id || ', warehouse='
                   || warehouse_id || ', qty=' || CAST(expired_qty AS VARCHAR) || ', expiry='
                   || CAST(final_expiry_date AS VARCHAR) AS detail
        FROM (SELECT *, item_id || '|' || lot_id || '|' || warehouse_id AS entity_id,
                     CAST(snapshot_date AS VARCHAR) AS period
              FROM lot_state WHERE expired_qty > 0) q""",
    "a2_resolved_basis": """
        SELECT invoice_no, invoice_line_no, charge_type, basis AS allocation_basis, rate,
               CASE WHEN scope <> '*' THEN scope END AS warehouse_scope
        FROM alloc_scope""",
    "a4_allocation_balance": """
        SELECT invoice_no, invoice_line_no, charge_type,
               round_even(amount, 0) AS allocated_total, count(*) AS targets
        FROM alloc_scope JOIN fact_shipment s ON scope = '*' OR scope = s.warehouse_id
        WHERE basis IS NOT NULL
        GROUP BY invoice_no, invoice_line_no, charge_type, amount""",
    "a5_largest_remainder": """
        SELECT l_orderkey, line_no,
               floor(raw) + CASE WHEN row_number() OVER (
                       PARTITION BY l_orderkey ORDER BY raw - floor(raw) DESC, line_no)
                   <= round_even(o_totalprice, 0) - sum(floor(raw)) OVER (PARTITION BY l_orderkey)
                   THEN 1 ELSE 0 END AS allocated
        FROM (SELECT l_orderkey, line_no, o_totalprice,
                     l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey) * o_totalprice
                         AS raw
              FROM lines JOIN orders ON l_orderkey = o_orderkey) q""",
    "a6_unallocated_charges": """
        SELECT invoice_no, invoice_line_no, charge_type, period, currency, amount,
               charge_domain, cost_stage FROM alloc_scope WHERE basis IS NULL""",
    "c10_effectiveness": """
        SELECT signal_id, metric_name, current_value AS before_value,
               0.0::DOUBLE AS after_value, -current_value AS delta, true AS resolved, period
        FROM mart_constraint_signals WHERE severity = 'CRITICAL' AND domain = 'supply'""",
    "v1_domain_rows": "SELECT domain, period, n AS included_rows FROM domain_rows",
    "v3_closed_period_gaps": """
        SELECT period, domain, coalesce(n, 0) AS included_rows,
               domain || ': closed period ' || period || ' has ' || coalesce(n, 0)
                   || ' rows and needs 1' AS message
        FROM (SELECT DISTINCT period FROM fact_exchange_rate WHERE period < '1996-01') p
        CROSS JOIN (VALUES ('fx_rate'), ('logistics_transport'), ('cost_structure')) d(domain)
        LEFT JOIN domain_rows USING (period, domain)
        WHERE coalesce(n, 0) < 1""",
    "d03_duplicate_keys": """
        SELECT file_name, 'duplicate_business_keys' AS check_name, 'HIGH' AS severity,
               extra = 0 AS passed, CAST(extra AS BIGINT) AS bad_rows,
               CASE WHEN extra = 0 THEN 'fact_order: keys are unique'
                    ELSE 'fact_order: ' || extra || ' rows repeat a key '
                         || '[''channel_order_id'', ''line_no'']' END AS detail
        FROM (SELECT file_name, count(*) - count(DISTINCT (channel_order_id, line_no)) AS extra
              FROM raw_orders GROUP BY file_name) q""",
    "d06_quality_results": """
        SELECT file_name, check_name, severity, bad_rows = 0 AS passed, bad_rows
        FROM quality_results""",
    "d07_failed_files": """
        SELECT file_name, 'fact_order: ' || max(CASE
                   WHEN check_name = 'null_business_key_channel_order_id' THEN bad_rows END)
                   || ' rows without key column channel_order_id' AS error,
               count(*) AS failed_checks
        FROM quality_results WHERE bad_rows > 0 GROUP BY file_name""",
    "d08_duplicate_grain": """
        SELECT period, item_id, channel_store_id, count(*) AS rows FROM mart_pnl_revenue
        GROUP BY ALL HAVING count(*) > 1""",
    "j06_asof_order_cost": """
        SELECT o.channel_order_id, o.line_no, o.item_id, o.order_date, c.unit_cost_krw
        FROM fact_order o ASOF JOIN unit_cost c
            ON o.item_id = c.item_id AND o.order_date >= c.effective_from""",
    "j07_latest_cost": """
        SELECT item_id, unit_cost_krw FROM unit_cost
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY effective_from DESC) = 1""",
    "o07_closed_period_gate": """
        SELECT strftime(order_date, '%Y-%m') AS period, count(*) AS rejected_rows
        FROM fact_order WHERE strftime(order_date, '%Y-%m') IN
            (SELECT period FROM fact_exchange_rate WHERE period < '1996-01')
        GROUP BY ALL""",
    "o08_coverage_gaps": """
        SELECT domain, period, coverage_rate, severity FROM mart_coverage_period
        WHERE severity <> 'OK' ORDER BY severity, domain, period LIMIT 10""",
    "r5_untied_charges": """
        SELECT 'CRITICAL' AS severity, * FROM mart_reco_charges WHERE NOT tied""",
    "s09_cast_columns": """
        SELECT source_system, channel_order_id, TRY_CAST(line_no AS BIGINT) AS line_no,
               TRY_CAST(order_date AS DATE) AS order_date, channel_store_id, item_id,
               TRY_CAST(qty_ordered AS DOUBLE) AS qty_ordered, file_name FROM raw_orders""",
    "s12_upsert": """
        SELECT o.channel_order_id, o.line_no, o.order_date,
               CASE WHEN l_returnflag = 'R' THEN 'CORRECTED' ELSE o.channel_store_id END
                   AS channel_store_id, o.item_id,
               CASE WHEN l_returnflag = 'R' THEN o.qty_ordered + 100 ELSE o.qty_ordered END
                   AS qty_ordered,
               CASE WHEN l_returnflag <> 'R' THEN o.ship_from_warehouse_id END
                   AS ship_from_warehouse_id
        FROM fact_order o JOIN lines l
            ON o.channel_order_id = CAST(l.l_orderkey AS VARCHAR) AND o.line_no = l.line_no""",
    "s20_rollback": """
        SELECT *, CAST(year(order_date) AS BIGINT) AS load_batch_id FROM fact_order
        WHERE year(order_date) NOT IN (2000, 2001)""",
    "s22_row_counts": """
        SELECT 'fact_order' AS table_name, count(*) AS row_count FROM fact_order
        UNION ALL SELECT 'fact_shipment', count(*) FROM fact_shipment
        UNION ALL SELECT 'fact_return', count(*) FROM fact_return
        UNION ALL SELECT 'fact_inventory_snapshot', count(*) FROM fact_inventory
        UNION ALL SELECT 'fact_po', count(*) FROM fact_po
        UNION ALL SELECT 'fact_receipt', count(*) FROM fact_receipt
        UNION ALL SELECT 'fact_settlement', count(*) FROM fact_settlement
        UNION ALL SELECT 'fact_charge_actual', count(*) FROM fact_charge
        UNION ALL SELECT 'fact_exchange_rate', count(*) FROM fact_exchange_rate
        UNION ALL SELECT 'fact_cost_structure', count(*) FROM fact_cost""",
    # ---- dashboards ---------------------------------------------------------------------
    "q01_inventory_kpis": """
        SELECT sum(onhand_qty) AS onhand_qty, sum(sellable_qty) AS sellable_qty,
               sum(blocked_qty) AS blocked_qty, sum(expired_qty) AS expired_qty,
               sum(blocked_qty) / sum(onhand_qty) AS blocked_ratio FROM lot_state""",
    "q02_inventory_value": """
        SELECT sum(onhand_qty * unit_cost_krw) AS total_value,
               sum(sellable_qty * unit_cost_krw) AS sellable_value,
               sum(blocked_qty * unit_cost_krw) AS hold_value,
               sum(expired_qty * unit_cost_krw) AS expired_value,
               count(unit_cost_krw) AS lots_with_cost,
               count(*) - count(unit_cost_krw) AS lots_without_cost
        FROM lot_state LEFT JOIN latest_cost USING (item_id)""",
    "q03_inventory_by_warehouse_type": """
        SELECT coalesce(warehouse_type, 'UNKNOWN') AS warehouse_type,
               coalesce(country, 'KR') AS country, sum(onhand_qty) AS onhand_qty,
               sum(sellable_qty) AS sellable_qty, sum(blocked_qty) AS blocked_qty,
               count(DISTINCT item_id) AS sku_count
        FROM lot_state LEFT JOIN dim_warehouse USING (warehouse_id)
        GROUP BY 1, 2""",
    "q04_onhand_by_bucket": """
        SELECT expiry_bucket, sum(onhand_qty) AS onhand_qty FROM lot_state GROUP BY ALL""",
    "q05_po_kpis": """
        SELECT count(*) AS po_lines, sum(qty_open) AS qty_open,
               count(*) FILTER (delay_days > 0) AS delayed, avg(po_lead_days) AS avg_lead_days,
               min(po_lead_days) AS min_lead_days, max(po_lead_days) AS max_lead_days
        FROM mart_open_po""",
    "q06_eta_accuracy": """
        SELECT avg(eta_vs_actual_days) AS avg_gap_days,
               count(*) FILTER (eta_vs_actual_days <= 0) AS on_time,
               count(*) FILTER (eta_vs_actual_days > 0) AS late
        FROM mart_open_po WHERE po_lead_days IS NOT NULL AND eta_vs_actual_days IS NOT NULL""",
    "q07_lead_time_by_supplier": """
        SELECT supplier_id, avg(po_lead_days) AS avg_lead_days, count(*) AS po_count
        FROM mart_open_po WHERE po_lead_days IS NOT NULL GROUP BY ALL""",
    "q08_shipment_kpis": """
        SELECT CAST(sum(total_shipments) AS BIGINT) AS total_shipments,
               sum(total_qty_shipped) AS total_qty_shipped, sum(total_weight) AS total_weight,
               round(avg(on_time_pct), 6) AS avg_on_time_pct,
               round(avg(avg_lead_days), 6) AS avg_lead_days FROM mart_shipment_performance""",
    "q08_shipments_by_warehouse": """
        SELECT warehouse_id, CAST(sum(total_shipments) AS BIGINT) AS total_shipments,
               sum(total_qty_shipped) AS total_qty_shipped,
               round(avg(on_time_pct), 6) AS avg_on_time_pct
        FROM mart_shipment_performance GROUP BY ALL""",
    "q08_shipments_by_channel": """
        SELECT channel_store_id, CAST(sum(total_shipments) AS BIGINT) AS total_shipments,
               sum(total_qty_shipped) AS total_qty_shipped,
               round(avg(on_time_pct), 6) AS avg_on_time_pct
        FROM mart_shipment_performance WHERE channel_store_id IS NOT NULL GROUP BY ALL""",
    "q09_backlog": """
        SELECT count(DISTINCT channel_order_id) AS open_orders, sum(qty_ordered) AS open_qty
        FROM open_lines""",
    "q10_matching_rates": """
        SELECT *, matched_orders / total_orders AS order_match_rate,
               matched_lines / total_lines AS line_match_rate
        FROM (SELECT count(*) AS total_orders, count(s.n) AS matched_orders,
                     CAST(sum(o.n) AS BIGINT) AS total_lines,
                     CAST(sum(s.n) AS BIGINT) AS matched_lines
              FROM (SELECT channel_order_id, count(*) AS n FROM fact_order GROUP BY ALL) o
              LEFT JOIN (SELECT channel_order_id, count(*) AS n FROM fact_shipment
                         WHERE channel_order_id IS NOT NULL GROUP BY ALL) s
                  USING (channel_order_id)) q""",
    "q11_shipment_trend": """
        SELECT ship_date, CAST(sum(shipment_count) AS BIGINT) AS shipment_count,
               sum(qty_shipped) AS qty_shipped FROM mart_shipment_daily GROUP BY ALL""",
    "q11_return_trend": """
        SELECT return_date, CAST(sum(return_count) AS BIGINT) AS return_count,
               sum(qty_returned) AS qty_returned FROM mart_return_daily GROUP BY ALL""",
    "q12_return_kpis": """
        SELECT CAST(sum(return_count) AS BIGINT) AS total_returns,
               sum(qty_returned) AS qty_returned, sum(qty_shipped) AS qty_shipped,
               sum(qty_returned) / sum(qty_shipped) AS return_rate FROM mart_return_analysis""",
    "q12_returns_by_reason": """
        SELECT reason, sum(qty_returned) AS qty_returned FROM mart_return_analysis
        WHERE reason IS NOT NULL GROUP BY ALL""",
    "q12_returns_by_disposition": """
        SELECT disposition, sum(qty_returned) AS qty_returned FROM mart_return_analysis
        WHERE disposition IS NOT NULL GROUP BY ALL""",
    "q12_top_return_items": """
        SELECT item_id, sum(qty_returned) AS qty_returned,
               coalesce(sum(qty_shipped), 0) AS qty_shipped,
               CAST(sum(return_count) AS BIGINT) AS return_count,
               CASE WHEN sum(qty_shipped) > 0 THEN sum(qty_returned) / sum(qty_shipped) * 100
                    ELSE 0 END AS return_rate
        FROM mart_return_analysis GROUP BY item_id ORDER BY return_rate DESC, item_id LIMIT 10""",
    "q13_stockout_count": """
        SELECT count(*) AS items, count(*) FILTER (risk_flag) AS flagged
        FROM mart_stockout_risk""",
    "q13_overstock_count": """
        SELECT count(*) AS items, count(*) FILTER (overstock_flag) AS flagged
        FROM mart_overstock""",
    "q14_turnover_kpis": """
        SELECT round(avg(turnover_ratio), 6) AS avg_turnover,
               count(*) FILTER (turnover_ratio < 0.5) AS slow_items FROM turnover""",
    "q14_slowest_items": """
        SELECT * FROM turnover ORDER BY turnover_ratio ASC NULLS FIRST, item_id LIMIT 10""",
    "q15_overstock_value": """
        SELECT round(sum(overstock_value), 0) AS overstock_value,
               count(*) - count(unit_cost_krw) AS without_cost FROM overstock_value""",
    "q15_top_overstock": """
        SELECT * FROM overstock_value
        ORDER BY overstock_value DESC NULLS LAST, item_id, warehouse_id LIMIT 10""",
    "q16_expiry_kpis": """
        SELECT count(*) AS lots, sum(onhand_qty) AS onhand_qty,
               sum(risk_value_krw) AS risk_value_krw,
               count(*) - count(risk_value_krw) AS without_value,
               avg(days_to_expiry) AS avg_days, min(days_to_expiry) AS min_days
        FROM mart_expiry_risk""",
    "q16_expiry_buckets": """
        SELECT expiry_bucket, sum(onhand_qty) AS onhand_qty, count(*) AS lots,
               coalesce(sum(risk_value_krw), 0) AS risk_value_krw
        FROM mart_expiry_risk GROUP BY ALL""",
    "q17_fefo_top": """
        SELECT * FROM mart_fefo_pick_list
        ORDER BY fefo_rank NULLS LAST, warehouse_id, item_id, lot_id, snapshot_date LIMIT 50""",
    "q18_service_level": """
        SELECT round(avg(service_level_pct), 6) AS avg_service_level FROM mart_service_level""",
    "q18_service_level_series": "SELECT * FROM mart_service_level",
    "q19_signal_counts": """
        SELECT count(*) FILTER (severity = 'CRITICAL') AS critical,
               count(*) FILTER (severity = 'HIGH') AS high, count(*) AS signals
        FROM mart_constraint_signals""",
    "q19_resolved_share": """
        SELECT count(*) AS resolved, count(*) AS signals FROM mart_constraint_signals
        WHERE severity = 'CRITICAL' AND domain = 'supply'""",
    "q20_reco_summary": """
        SELECT 'inventory_movement' AS area, count(*) AS rows,
               count(*) FILTER (severity IN ('warn', 'high')) AS issues,
               NULL::DOUBLE AS delta_sum, NULL::DOUBLE AS delta_abs, NULL::DOUBLE AS mean_rate,
               NULL::DOUBLE AS delta_ratio FROM mart_reco_inventory_movement
        UNION ALL
        SELECT 'oms_vs_wms', count(*), count(*) FILTER (delta <> 0), sum(delta),
               sum(abs(delta)), round(avg(fulfillment_rate), 6), NULL FROM mart_reco_oms_vs_wms
        UNION ALL
        SELECT 'erp_vs_wms_receipt', count(*), count(*) FILTER (delta <> 0), NULL, NULL, NULL,
               NULL FROM mart_reco_erp_gr_vs_wms_receipt
        UNION ALL
        SELECT 'settlement_vs_estimated', count(*), count(*) FILTER (delta_krw <> 0),
               sum(delta_krw), sum(abs(delta_krw)), NULL,
               sum(abs(delta_krw)) / abs(sum(settlement_revenue_krw))
        FROM mart_reco_settlement_vs_estimated
        UNION ALL
        SELECT 'charges_invoice_vs_allocated', count(*), count(*) FILTER (NOT tied), sum(delta),
               sum(abs(delta)), NULL, sum(abs(delta)) / abs(sum(invoice_total))
        FROM mart_reco_charges""",
    "q21_waterfall": "SELECT * FROM mart_pnl_waterfall_summary WHERE period = '1997-03'",
    "q22_revenue_kpis": """
        SELECT sum(gross_sales_krw) AS gross_sales_krw, sum(discounts_krw) AS discounts_krw,
               sum(refunds_krw) AS refunds_krw, sum(net_revenue_krw) AS net_revenue_krw,
               count(*) FILTER (coverage_flag = 'ACTUAL') AS actual_rows,
               count(*) FILTER (coverage_flag <> 'ACTUAL') AS partial_rows,
               abs(sum(discounts_krw)) / abs(sum(gross_sales_krw)) AS discount_rate
        FROM mart_pnl_revenue""",
    "q22_revenue_by_store": """
        SELECT channel_store_id, sum(net_revenue_krw) AS net_revenue_krw
        FROM mart_pnl_revenue GROUP BY ALL""",
    "q23_coverage_totals": """
        SELECT mart, sum(amount) FILTER (coverage_flag = 'ACTUAL') AS known_sum,
               sum(coalesce(amount, 0)) AS total_sum_min, count(*) AS total_count,
               count(*) FILTER (coverage_flag <> 'ACTUAL') AS partial_count,
               count(*) FILTER (coverage_flag = 'ACTUAL') AS actual_count
        FROM (SELECT 'cogs' AS mart, cogs_krw AS amount, coverage_flag FROM mart_pnl_cogs
              UNION ALL SELECT 'gross_margin', gross_margin_krw, coverage_flag
              FROM mart_pnl_gross_margin
              UNION ALL SELECT 'contribution', contribution_krw, coverage_flag
              FROM mart_pnl_contribution) q GROUP BY mart""",
    "q24_mean_margins": """
        SELECT mart, round(avg(pct), 6) AS avg_pct
        FROM (SELECT 'gross_margin' AS mart, gross_margin_pct AS pct, coverage_flag
              FROM mart_pnl_gross_margin
              UNION ALL SELECT 'contribution', contribution_pct, coverage_flag
              FROM mart_pnl_contribution
              UNION ALL SELECT 'operating_profit', operating_profit_pct, coverage_flag
              FROM mart_pnl_operating_profit) q
        WHERE coverage_flag = 'ACTUAL' GROUP BY mart""",
    "q25_cost_by_domain": """
        SELECT charge_domain, sum(allocated_amount_krw) AS allocated_amount_krw
        FROM mart_pnl_variable_cost GROUP BY ALL""",
    "q25_cost_by_stage": """
        SELECT cost_stage, sum(allocated_amount_krw) AS allocated_amount_krw
        FROM mart_charge_allocated GROUP BY ALL""",
    "q26_logistics_ratio": """
        SELECT c AS logistics_krw, r AS revenue_krw, c / r AS logistics_ratio
        FROM (SELECT sum(allocated_amount_krw) AS c FROM mart_pnl_variable_cost
              WHERE charge_domain IN ('logistics_transport', '3pl_billing')) a,
             (SELECT sum(net_revenue_krw) AS r FROM mart_pnl_revenue) b""",
    "q27_unit_costs": """
        SELECT total_vc, total_vc / orders AS vc_per_order, total_vc / qty AS vc_per_piece,
               CASE WHEN wc >= 0.8 AND weight > 0 THEN total_vc / weight END AS vc_per_kg,
               CASE WHEN vc >= 0.8 AND volume > 0 THEN total_vc / volume END AS vc_per_cbm,
               wc AS weight_coverage, vc AS volume_coverage
        FROM (SELECT sum(allocated_amount_krw) AS total_vc FROM mart_pnl_variable_cost) a,
             (SELECT count(DISTINCT channel_order_id) AS orders, sum(qty_shipped) AS qty,
                     sum(weight) AS weight, sum(volume_cbm) AS volume,
                     count(*) FILTER (weight <> 0) / count(*) AS wc,
                     count(*) FILTER (volume_cbm <> 0) / count(*) AS vc
              FROM fact_shipment WHERE channel_order_id IS NOT NULL) b""",
    "q28_item_ranking": """
        WITH r AS MATERIALIZED (SELECT item_id, sum(contribution_krw) AS contribution_krw,
                     round(avg(contribution_pct), 6) AS contribution_pct,
                     bool_or(coverage_flag <> 'ACTUAL') AS is_partial
              FROM mart_pnl_contribution WHERE item_id IS NOT NULL GROUP BY ALL)
        SELECT *, 'TOP' AS side FROM (SELECT * FROM r ORDER BY contribution_krw DESC, item_id
                                      LIMIT 10)
        UNION ALL
        SELECT *, 'BOTTOM' FROM (SELECT * FROM r ORDER BY contribution_krw, item_id LIMIT 10)""",
    "q28_store_ranking": """
        WITH r AS MATERIALIZED (SELECT channel_store_id,
                     sum(contribution_krw) AS contribution_krw,
                     round(avg(contribution_pct), 6) AS contribution_pct,
                     bool_or(coverage_flag <> 'ACTUAL') AS is_partial
              FROM mart_pnl_contribution WHERE channel_store_id IS NOT NULL GROUP BY ALL)
        SELECT *, 'TOP' AS side FROM (SELECT * FROM r ORDER BY contribution_krw DESC,
                                      channel_store_id LIMIT 10)
        UNION ALL
        SELECT *, 'BOTTOM' FROM (SELECT * FROM r ORDER BY contribution_krw, channel_store_id
                                 LIMIT 10)""",
    "q29_coverage_counts": """
        SELECT count(*) FILTER (severity = 'OK') AS ok,
               count(*) FILTER (severity = 'WARN') AS warn,
               count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) AS cells
        FROM mart_coverage_period""",
    "q30_fx_coverage": """
        SELECT period, currency,
               CASE WHEN rate_to_krw IS NULL THEN 'MISSING' ELSE 'OK' END AS status
        FROM (SELECT DISTINCT period, currency FROM fact_settlement WHERE currency <> 'KRW') s
        LEFT JOIN fact_exchange_rate USING (period, currency)""",
    "q31_coverage_flags": """
        SELECT mart, count(*) AS total, count(*) FILTER (coverage_flag = 'ACTUAL') AS actual,
               count(*) FILTER (coverage_flag <> 'ACTUAL') AS partial,
               count(*) FILTER (coverage_flag = 'ACTUAL') * 100 / count(*) AS actual_pct
        FROM (SELECT 'revenue' AS mart, coverage_flag FROM mart_pnl_revenue
              UNION ALL SELECT 'cogs', coverage_flag FROM mart_pnl_cogs
              UNION ALL SELECT 'gross_margin', coverage_flag FROM mart_pnl_gross_margin
              UNION ALL SELECT 'variable_cost', coverage_flag FROM mart_pnl_variable_cost
              UNION ALL SELECT 'contribution', coverage_flag FROM mart_pnl_contribution
              UNION ALL SELECT 'operating_profit', coverage_flag
              FROM mart_pnl_operating_profit) q GROUP BY mart""",
    "q32_scenario_costs": "SELECT * FROM scenario_costs",
    "q32_scenario_summary": """
        SELECT scenario, sum(estimate) AS total_cost,
               sum(estimate) / (SELECT q FROM basis_totals WHERE basis = 'order_count')
                   AS cost_per_order,
               sum(estimate) / (SELECT q FROM basis_totals WHERE basis = 'qty')
                   AS cost_per_piece,
               sum(estimate) / (SELECT q FROM basis_totals WHERE basis = 'revenue')
                   AS cost_to_revenue
        FROM scenario_costs GROUP BY scenario""",
    "q32_scenario_stages": """
        SELECT scenario, cost_stage, sum(estimate) AS cost,
               sum(estimate) / sum(sum(estimate)) OVER (PARTITION BY scenario) AS share
        FROM scenario_costs GROUP BY scenario, cost_stage""",
    "q32_scenario_top": """
        SELECT scenario, CAST(row_number() OVER w AS INTEGER) AS rank, charge_type, estimate
        FROM scenario_costs
        WINDOW w AS (PARTITION BY scenario ORDER BY estimate DESC, charge_type)
        QUALIFY row_number() OVER w <= 5""",
}
for name, cte in {
    "c1_late_po": "sig_late_po", "c2_supplier_delay": "sig_supplier_delay",
    "c3_backlog": "sig_backlog", "c4_dwell_time": "sig_dwell",
    "c5_return_spike": "sig_return_spike", "c6_expired_stock": "sig_expired",
}.items():
    SQL[name] = f"""
        SELECT 'SIG-' || upper(substr(sha256(domain || '|' || metric_name || '|' || entity_id
                   || '|' || period), 1, 16)) AS signal_id, * FROM {cte}"""

SQL["q33_periods"] = """
        SELECT period FROM mart_shipment_performance WHERE period IS NOT NULL
        UNION SELECT period FROM mart_return_analysis WHERE period IS NOT NULL
        UNION SELECT period FROM mart_pnl_revenue WHERE period IS NOT NULL
        UNION SELECT period FROM mart_pnl_variable_cost WHERE period IS NOT NULL
        UNION SELECT period FROM mart_pnl_contribution WHERE period IS NOT NULL"""


def in_period(sql: str, period: str) -> str:
    """The same SQL over one period of its marts and of the shipments."""
    sql = re.sub(r"\b(mart_\w+)", rf"(SELECT * FROM \1 WHERE period = '{period}')", sql)
    return sql.replace(
        "fact_shipment", f"(SELECT * FROM fact_shipment WHERE strftime(ship_date, '%Y-%m') = '{period}')")


PERIOD = "1997-03"
for name in [
    "q08_shipment_kpis", "q08_shipments_by_warehouse", "q08_shipments_by_channel",
    "q12_return_kpis", "q12_returns_by_reason", "q12_returns_by_disposition",
    "q12_top_return_items", "q22_revenue_kpis", "q22_revenue_by_store", "q23_coverage_totals",
    "q24_mean_margins", "q25_cost_by_domain", "q25_cost_by_stage", "q26_logistics_ratio",
    "q27_unit_costs", "q28_item_ranking", "q28_store_ranking",
]:
    SQL[f"{name}_in_period"] = in_period(SQL[name], PERIOD)


def oracle_sql() -> dict[str, str]:
    plain = {name: f"SELECT * FROM {cte}" for name, cte in MART_SQL.items()}
    return {name: with_ctes(sql) for name, sql in {**plain, **SQL}.items()}

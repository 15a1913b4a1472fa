"""Each mart as SQL over the fact CTEs: the yardstick the Spark plans are compared with."""

TODAY = "DATE '2001-12-31'"

MARTS = {
    # ---- expiry -------------------------------------------------------------------------
    "lot_expiry": """
        SELECT s.*, i.item_type, i.qc_required_flag, s.expiry_date AS final_expiry_date,
               CAST(coalesce(i.min_sellable_days,
                    CASE i.item_type WHEN 'RM' THEN 30 WHEN 'PM' THEN 90 WHEN 'FG' THEN 60
                         ELSE 60 END) AS INTEGER) AS min_days
        FROM fact_inventory s LEFT JOIN dim_item i USING (item_id)""",
    "lot_state": """
        SELECT *, greatest(onhand_qty - expired_qty - blocked_qty, 0.0::DOUBLE) AS sellable_qty,
               CAST(final_expiry_date - snapshot_date AS INTEGER) AS days_to_expiry,
               CASE WHEN final_expiry_date IS NULL THEN 'N/A'
                    WHEN final_expiry_date - snapshot_date < 0 THEN 'EXPIRED'
                    WHEN final_expiry_date - snapshot_date < 30 THEN '0-30d'
                    WHEN final_expiry_date - snapshot_date < 60 THEN '30-60d'
                    WHEN final_expiry_date - snapshot_date < 90 THEN '60-90d'
                    WHEN final_expiry_date - snapshot_date < 180 THEN '90-180d'
                    WHEN final_expiry_date - snapshot_date < 365 THEN '180-365d'
                    ELSE '>365d' END AS expiry_bucket
        FROM (SELECT *,
                CASE WHEN final_expiry_date < snapshot_date THEN onhand_qty
                     ELSE 0.0::DOUBLE END AS expired_qty,
                CASE WHEN hold_flag
                       OR (coalesce(qc_required_flag, false)
                           AND lower(coalesce(qc_status, '')) <> 'released')
                       OR (final_expiry_date >= snapshot_date
                           AND final_expiry_date < snapshot_date + min_days)
                     THEN onhand_qty ELSE 0.0::DOUBLE END AS blocked_qty
              FROM lot_expiry) q""",
    "fefo": """
        SELECT *, CASE WHEN final_expiry_date IS NOT NULL THEN CAST(row_number() OVER (
                   PARTITION BY warehouse_id, item_id
                   ORDER BY final_expiry_date ASC NULLS LAST, lot_id, snapshot_date) AS INTEGER)
                   END AS fefo_rank
        FROM lot_state""",
    "mart_inventory_onhand": """
        SELECT snapshot_date, warehouse_id, item_id, lot_id, onhand_qty, sellable_qty,
               blocked_qty, expired_qty, final_expiry_date, expiry_bucket, fefo_rank,
               min_days AS min_sellable_days
        FROM fefo""",
    # ---- supply chain -------------------------------------------------------------------
    "mart_open_po": f"""
        SELECT po_id, p.item_id, supplier_id, po_date, eta_date, first_receipt_date, qty_ordered,
               coalesce(r.qty_received, 0) AS qty_received,
               greatest(qty_ordered - coalesce(r.qty_received, 0), 0) AS qty_open,
               CAST(CASE WHEN eta_date < {TODAY} THEN {TODAY} - eta_date ELSE 0 END AS INTEGER)
                   AS delay_days,
               CAST(first_receipt_date - po_date AS INTEGER) AS po_lead_days,
               CAST(first_receipt_date - eta_date AS INTEGER) AS eta_vs_actual_days,
               strftime(po_date, '%Y-%m') AS period
        FROM fact_po p LEFT JOIN (
            SELECT po_id, item_id, sum(qty_received) AS qty_received,
                   min(receipt_date) AS first_receipt_date
            FROM fact_receipt WHERE po_id IS NOT NULL GROUP BY ALL) r USING (po_id, item_id)""",
    "demand": """
        SELECT warehouse_id, item_id,
               sum(qty_shipped) / greatest(max(ship_date) - min(ship_date) + 1, 1)
                   AS avg_daily_demand
        FROM fact_shipment WHERE channel_order_id IS NOT NULL GROUP BY ALL""",
    "mart_stockout_risk": """
        SELECT item_id, warehouse_id, sellable_qty, avg_daily_demand, days_of_cover,
               CAST(7 AS INTEGER) AS threshold_days, days_of_cover < 7 AS risk_flag, as_of_date
        FROM (SELECT s.*, coalesce(d.avg_daily_demand, 0) AS avg_daily_demand,
                     CASE WHEN d.avg_daily_demand > 0 THEN s.sellable_qty / d.avg_daily_demand
                          ELSE 'infinity'::DOUBLE END AS days_of_cover
              FROM (SELECT warehouse_id, item_id, sum(sellable_qty) AS sellable_qty,
                           max(snapshot_date) AS as_of_date
                    FROM lot_state GROUP BY ALL) s
              LEFT JOIN demand d USING (warehouse_id, item_id)) q""",
    "mart_overstock": """
        SELECT *, CASE WHEN overstock_flag
                       THEN greatest(onhand_qty - avg_daily_demand * doh_threshold, 0.0::DOUBLE)
                       ELSE 0.0::DOUBLE END AS overstock_qty
        FROM (SELECT *, days_on_hand > doh_threshold AS overstock_flag
              FROM (SELECT s.item_id, s.warehouse_id, s.item_type, s.onhand_qty,
                           coalesce(d.avg_daily_demand, 0) AS avg_daily_demand,
                           CASE WHEN d.avg_daily_demand > 0
                                THEN s.onhand_qty / d.avg_daily_demand
                                ELSE 'infinity'::DOUBLE END AS days_on_hand,
                           CAST(CASE s.item_type WHEN 'RM' THEN 120 WHEN 'PM' THEN 180
                                     ELSE 90 END AS INTEGER) AS doh_threshold,
                           s.as_of_date
                    FROM (SELECT v.warehouse_id, v.item_id,
                                 coalesce(i.item_type, 'FG') AS item_type,
                                 sum(onhand_qty) AS onhand_qty, max(snapshot_date) AS as_of_date
                          FROM fact_inventory v LEFT JOIN dim_item i USING (item_id)
                          GROUP BY ALL) s
                    LEFT JOIN demand d USING (warehouse_id, item_id)) a) b""",
    "unit_cost": """
        SELECT item_id, effective_from, sum(cost_per_unit_krw) AS unit_cost_krw
        FROM fact_cost GROUP BY ALL""",
    "mart_expiry_risk": """
        SELECT l.item_id, l.warehouse_id, l.lot_id, l.onhand_qty, l.final_expiry_date,
               l.days_to_expiry, l.expiry_bucket,
               l.onhand_qty * c.unit_cost_krw AS risk_value_krw, l.snapshot_date AS as_of_date
        FROM (SELECT * FROM lot_state WHERE final_expiry_date IS NOT NULL) l
        ASOF LEFT JOIN unit_cost c
            ON l.item_id = c.item_id AND l.snapshot_date >= c.effective_from""",
    "mart_fefo_pick_list": """
        SELECT warehouse_id, item_id, lot_id, onhand_qty, sellable_qty, final_expiry_date,
               fefo_rank, snapshot_date
        FROM fefo""",
    "mart_service_level": """
        SELECT week_start, channel_store_id, count(*) AS total_orders,
               CAST(sum(CASE WHEN on_time THEN 1 ELSE 0 END) AS BIGINT) AS shipped_on_time,
               sum(CASE WHEN on_time THEN 1 ELSE 0 END) / count(*) AS service_level_pct
        FROM (SELECT CAST(date_trunc('week', o.order_date) AS DATE) AS week_start,
                     o.channel_store_id, s.first_ship <= o.order_date + 3 AS on_time
              FROM fact_order o LEFT JOIN (
                  SELECT channel_order_id, min(ship_date) AS first_ship FROM fact_shipment
                  WHERE channel_order_id IS NOT NULL GROUP BY ALL) s USING (channel_order_id)) q
        GROUP BY week_start, channel_store_id""",
    "mart_shipment_performance": """
        SELECT *, on_time_count / total_shipments AS on_time_pct
        FROM (SELECT strftime(ship_date, '%Y-%m') AS period, warehouse_id, channel_store_id,
                     count(DISTINCT shipment_id) AS total_shipments,
                     sum(qty_shipped) AS total_qty_shipped,
                     coalesce(sum(weight), 0) AS total_weight,
                     coalesce(sum(volume_cbm), 0) AS total_volume_cbm,
                     avg(qty_shipped) AS avg_qty_per_shipment,
                     avg(ship_date - order_date) AS avg_lead_days,
                     CAST(sum(CASE WHEN ship_date <= order_date + 3 THEN 1 ELSE 0 END) AS BIGINT)
                         AS on_time_count
              FROM fact_shipment LEFT JOIN (
                  SELECT channel_order_id, min(order_date) AS order_date FROM fact_order
                  GROUP BY ALL) o USING (channel_order_id)
              GROUP BY ALL) q""",
    "mart_shipment_daily": """
        SELECT ship_date, warehouse_id, count(DISTINCT shipment_id) AS shipment_count,
               sum(qty_shipped) AS qty_shipped, coalesce(sum(weight), 0) AS weight,
               coalesce(sum(volume_cbm), 0) AS volume_cbm,
               count(DISTINCT channel_order_id)
                   + max(CASE WHEN channel_order_id IS NULL THEN 1 ELSE 0 END) AS unique_orders,
               count(DISTINCT item_id) AS unique_items
        FROM fact_shipment GROUP BY ship_date, warehouse_id""",
    "mart_return_analysis": """
        SELECT r.*, s.qty_shipped,
               CASE WHEN s.qty_shipped > 0 THEN r.qty_returned / s.qty_shipped
                    ELSE 0.0::DOUBLE END AS return_rate
        FROM (SELECT strftime(return_date, '%Y-%m') AS period, item_id, warehouse_id,
                     channel_store_id, reason, disposition,
                     count(DISTINCT return_id) AS return_count, sum(qty_returned) AS qty_returned
              FROM fact_return LEFT JOIN (
                  SELECT DISTINCT channel_order_id, channel_store_id FROM fact_order) o
                  USING (channel_order_id)
              GROUP BY ALL) r
        LEFT JOIN (SELECT strftime(ship_date, '%Y-%m') AS period, item_id, warehouse_id,
                          sum(qty_shipped) AS qty_shipped
                   FROM fact_shipment GROUP BY ALL) s USING (period, item_id, warehouse_id)""",
    "mart_return_daily": """
        SELECT v.*, t.top_reason
        FROM (SELECT return_date, warehouse_id, count(DISTINCT return_id) AS return_count,
                     sum(qty_returned) AS qty_returned,
                     count(DISTINCT channel_order_id)
                       + max(CASE WHEN channel_order_id IS NULL THEN 1 ELSE 0 END)
                       AS unique_orders,
                     count(DISTINCT item_id) AS unique_items
              FROM fact_return GROUP BY ALL) v
        LEFT JOIN (SELECT return_date, warehouse_id, reason AS top_reason
                   FROM (SELECT return_date, warehouse_id, reason, count(*) AS n
                         FROM fact_return WHERE reason IS NOT NULL GROUP BY ALL) c
                   QUALIFY row_number() OVER (PARTITION BY return_date, warehouse_id
                                              ORDER BY n DESC, reason) = 1) t
            USING (return_date, warehouse_id)""",
    # ---- allocation ---------------------------------------------------------------------
    "alloc_scope": """
        SELECT c.*, coalesce(k.warehouse_id, '*') AS scope,
               CASE WHEN c.currency = 'KRW' THEN 1.0::DOUBLE
                    ELSE coalesce(fx.rate_to_krw, 1.0::DOUBLE) END AS rate,
               p.charge_domain, p.cost_stage, p.capitalizable_flag,
               CASE WHEN p.charge_type = 'LAST_MILE_PARCEL' THEN 'order_count'
                    WHEN p.charge_type = '3PL_STORAGE_FEE' THEN NULL
                    WHEN p.cost_stage = 'inbound_landed' THEN
                        CASE WHEN w.any_weight THEN 'weight' WHEN w.any_volume THEN 'volume_cbm'
                             WHEN w.any_qty THEN 'value' END
                    WHEN p.cost_stage = 'outbound' THEN 'order_count'
                    WHEN p.cost_stage = 'returns' THEN 'line_count'
                    WHEN p.cost_stage = 'period' THEN 'revenue' END AS basis
        FROM fact_charge c
        JOIN policy p USING (charge_type)
        LEFT JOIN fact_exchange_rate fx USING (period, currency)
        LEFT JOIN (SELECT DISTINCT warehouse_id FROM fact_shipment) k
            ON c.warehouse_id = k.warehouse_id
        JOIN (SELECT warehouse_id AS scope, bool_or(coalesce(weight, 0) <> 0) AS any_weight,
                     bool_or(coalesce(volume_cbm, 0) <> 0) AS any_volume,
                     bool_or(qty_shipped <> 0) AS any_qty
              FROM fact_shipment GROUP BY ALL
              UNION ALL
              SELECT '*', bool_or(coalesce(weight, 0) <> 0), bool_or(coalesce(volume_cbm, 0) <> 0),
                     bool_or(qty_shipped <> 0) FROM fact_shipment) w
            ON w.scope = coalesce(k.warehouse_id, '*')""",
    "alloc_share": """
        SELECT *, CASE WHEN sum(basis_value) OVER inv = 0 THEN amount / count(*) OVER inv
                       ELSE basis_value / sum(basis_value) OVER inv * amount END AS raw
        FROM (SELECT c.* EXCLUDE (warehouse_id, channel_store_id), s.shipment_id, s.item_id,
                     s.warehouse_id, s.channel_store_id, s.lot_id,
                     CASE c.basis WHEN 'weight' THEN coalesce(s.weight, 0)
                          WHEN 'volume_cbm' THEN s.volume_cbm WHEN 'value' THEN s.qty_shipped
                          ELSE 1.0::DOUBLE END AS basis_value
              FROM alloc_scope c
              JOIN fact_shipment s ON c.scope = '*' OR c.scope = s.warehouse_id
              WHERE c.basis IS NOT NULL) t
        WINDOW inv AS (PARTITION BY invoice_no, invoice_line_no, charge_type)""",
    "mart_charge_allocated": """
        SELECT period, charge_type, charge_domain, cost_stage, invoice_no, invoice_line_no,
               item_id, warehouse_id, channel_store_id, lot_id, basis AS allocation_basis,
               basis_value, allocated_amount, allocated_amount * rate AS allocated_amount_krw,
               currency, capitalizable_flag
        FROM (SELECT *, floor(raw) + CASE WHEN row_number() OVER (
                         PARTITION BY invoice_no, invoice_line_no, charge_type
                         ORDER BY raw - floor(raw) DESC, warehouse_id,
                                  channel_store_id NULLS FIRST, item_id, lot_id, shipment_id)
                       <= round_even(amount, 0) - sum(floor(raw)) OVER (
                         PARTITION BY invoice_no, invoice_line_no, charge_type)
                     THEN 1 ELSE 0 END AS allocated_amount
              FROM alloc_share) q""",
    # ---- profit and loss ----------------------------------------------------------------
    "mart_pnl_revenue": """
        SELECT period, item_id, channel_store_id, 'KR' AS country,
               gross_sales * rate AS gross_sales_krw, discounts * rate AS discounts_krw,
               refunds * rate AS refunds_krw, net_payout * rate AS net_revenue_krw,
               'settlement' AS source,
               CASE WHEN rate IS NULL THEN 'PARTIAL' ELSE 'ACTUAL' END AS coverage_flag
        FROM (SELECT s.*, CASE WHEN s.currency = 'KRW' THEN 1.0::DOUBLE ELSE rate_to_krw END
                     AS rate
              FROM fact_settlement s LEFT JOIN fact_exchange_rate USING (period, currency)) q""",
    "mart_pnl_cogs": """
        SELECT n.period, n.item_id, n.channel_store_id, 'KR' AS country, n.qty_shipped,
               n.qty_returned, n.qty_shipped - n.qty_returned AS qty_net, c.unit_cost_krw,
               (n.qty_shipped - n.qty_returned) * c.unit_cost_krw AS cogs_krw,
               CASE WHEN c.unit_cost_krw IS NULL THEN 'PARTIAL' ELSE 'ACTUAL' END AS coverage_flag
        FROM (SELECT s.*, coalesce(r.qty_returned, 0) AS qty_returned,
                     last_day(CAST(s.period || '-01' AS DATE)) AS period_end
              FROM (SELECT strftime(ship_date, '%Y-%m') AS period, item_id,
                           coalesce(channel_store_id, 'UNKNOWN') AS channel_store_id,
                           sum(qty_shipped) AS qty_shipped
                    FROM fact_shipment WHERE channel_order_id IS NOT NULL GROUP BY ALL) s
              LEFT JOIN (SELECT strftime(return_date, '%Y-%m') AS period, item_id,
                                sum(qty_returned) AS qty_returned
                         FROM fact_return WHERE channel_order_id IS NOT NULL GROUP BY ALL) r
                  USING (period, item_id)) n
        ASOF LEFT JOIN unit_cost c
            ON n.item_id = c.item_id AND n.period_end >= c.effective_from""",
    "mart_pnl_gross_margin": """
        SELECT coalesce(r.period, c.period) AS period, coalesce(r.item_id, c.item_id) AS item_id,
               coalesce(r.channel_store_id, c.channel_store_id) AS channel_store_id,
               coalesce(r.country, c.country, 'KR') AS country,
               coalesce(r.net_revenue_krw, 0) AS net_revenue_krw,
               coalesce(c.cogs_krw, 0) AS cogs_krw,
               coalesce(r.net_revenue_krw, 0) - coalesce(c.cogs_krw, 0) AS gross_margin_krw,
               CASE WHEN coalesce(r.net_revenue_krw, 0) <> 0
                    THEN (r.net_revenue_krw - coalesce(c.cogs_krw, 0)) / r.net_revenue_krw
                    ELSE 0.0::DOUBLE END AS gross_margin_pct,
               CASE WHEN r.coverage_flag = 'ACTUAL' AND c.coverage_flag = 'ACTUAL'
                    THEN 'ACTUAL' ELSE 'PARTIAL' END AS coverage_flag
        FROM mart_pnl_revenue r FULL JOIN mart_pnl_cogs c
            ON r.period = c.period AND r.item_id = c.item_id
           AND r.channel_store_id = c.channel_store_id""",
    "mart_pnl_variable_cost": """
        SELECT period, coalesce(item_id, 'ALL') AS item_id,
               coalesce(channel_store_id, 'ALL') AS channel_store_id, 'KR' AS country,
               charge_domain, charge_type, sum(allocated_amount_krw) AS allocated_amount_krw,
               'ACTUAL' AS coverage_flag
        FROM mart_charge_allocated
        GROUP BY period, mart_charge_allocated.item_id, mart_charge_allocated.channel_store_id,
                 charge_domain, charge_type""",
    "mart_pnl_contribution": """
        SELECT g.period, g.item_id, g.channel_store_id, g.country, g.gross_margin_krw,
               coalesce(v.total, 0) AS total_variable_cost_krw,
               g.gross_margin_krw - coalesce(v.total, 0) AS contribution_krw,
               CASE WHEN g.net_revenue_krw <> 0
                    THEN (g.gross_margin_krw - coalesce(v.total, 0)) / g.net_revenue_krw
                    ELSE 0.0::DOUBLE END AS contribution_pct,
               g.coverage_flag
        FROM mart_pnl_gross_margin g LEFT JOIN (
            SELECT period, item_id, channel_store_id, sum(allocated_amount_krw) AS total
            FROM mart_pnl_variable_cost GROUP BY ALL) v
            USING (period, item_id, channel_store_id)""",
    "mart_pnl_operating_profit": """
        SELECT period, item_id, channel_store_id, country, contribution_krw,
               0.0::DOUBLE AS fixed_cost_krw, contribution_krw AS operating_profit_krw,
               contribution_pct AS operating_profit_pct, coverage_flag
        FROM mart_pnl_contribution""",
    "mart_pnl_waterfall_summary": """
        SELECT period, '매출 (Net Revenue)' AS metric_name, 1 AS metric_order,
               coalesce(sum(net_revenue_krw), 0) AS amount_krw FROM mart_pnl_revenue GROUP BY ALL
        UNION ALL
        SELECT period, '매출원가 (COGS)', 2, coalesce(sum(cogs_krw), 0)
        FROM mart_pnl_cogs GROUP BY ALL
        UNION ALL
        SELECT period, '매출총이익 (Gross Margin)', 3, coalesce(sum(gross_margin_krw), 0)
        FROM mart_pnl_gross_margin GROUP BY ALL
        UNION ALL
        SELECT period, '변동비 (Variable Cost)', 4, coalesce(sum(allocated_amount_krw), 0)
        FROM mart_pnl_variable_cost GROUP BY ALL
        UNION ALL
        SELECT period, '공헌이익 (Contribution)', 5, coalesce(sum(contribution_krw), 0)
        FROM mart_pnl_contribution GROUP BY ALL
        UNION ALL
        SELECT period, '영업이익 (Operating Profit)', 6, coalesce(sum(operating_profit_krw), 0)
        FROM mart_pnl_operating_profit GROUP BY ALL""",
    # ---- reconciliation -----------------------------------------------------------------
    "stock_by_day": """
        SELECT snapshot_date, warehouse_id, item_id, sum(onhand_qty) AS onhand
        FROM fact_inventory GROUP BY ALL""",
    "mart_reco_inventory_movement": """
        SELECT snapshot_date, warehouse_id, item_id, prev_onhand, receipts, shipments, returns,
               adjustments, actual_onhand - 2 * adjustments AS expected_onhand, actual_onhand,
               2 * adjustments AS delta,
               CASE WHEN abs(prev_onhand) > 0 THEN 2 * adjustments / abs(prev_onhand)
                    WHEN adjustments <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS delta_ratio,
               CASE WHEN share >= 0.03 THEN 'high' WHEN share >= 0.01 THEN 'warn' ELSE 'ok' END
                   AS severity
        FROM (SELECT *, CASE WHEN abs(prev_onhand) > 0
                             THEN abs(adjustments) / abs(prev_onhand)
                             WHEN adjustments <> 0 THEN 1 ELSE 0 END AS share
              FROM (SELECT t.snapshot_date, t.warehouse_id, t.item_id, y.onhand AS prev_onhand,
                           coalesce(rc.q, 0) AS receipts, coalesce(sh.q, 0) AS shipments,
                           coalesce(rt.q, 0) AS returns, t.onhand AS actual_onhand,
                           t.onhand - (y.onhand + coalesce(rc.q, 0) - coalesce(sh.q, 0)
                                       + coalesce(rt.q, 0)) AS adjustments
                    FROM stock_by_day t
                    JOIN stock_by_day y ON y.snapshot_date = t.snapshot_date - 1
                         AND y.warehouse_id = t.warehouse_id AND y.item_id = t.item_id
                    LEFT JOIN (SELECT receipt_date AS d, warehouse_id, item_id,
                                      sum(qty_received) AS q FROM fact_receipt GROUP BY ALL) rc
                        ON rc.d = t.snapshot_date AND rc.warehouse_id = t.warehouse_id
                           AND rc.item_id = t.item_id
                    LEFT JOIN (SELECT ship_date AS d, warehouse_id, item_id,
                                      sum(qty_shipped) AS q FROM fact_shipment GROUP BY ALL) sh
                        ON sh.d = t.snapshot_date AND sh.warehouse_id = t.warehouse_id
                           AND sh.item_id = t.item_id
                    LEFT JOIN (SELECT return_date AS d, warehouse_id, item_id,
                                      sum(qty_returned) AS q FROM fact_return GROUP BY ALL) rt
                        ON rt.d = t.snapshot_date AND rt.warehouse_id = t.warehouse_id
                           AND rt.item_id = t.item_id) a) b""",
    "mart_reco_oms_vs_wms": """
        SELECT period, item_id, channel_store_id, oms_qty_ordered, wms_qty_shipped,
               oms_qty_ordered - wms_qty_shipped AS delta,
               CASE WHEN oms_qty_ordered > 0 THEN wms_qty_shipped / oms_qty_ordered END
                   AS fulfillment_rate
        FROM (SELECT period, item_id, channel_store_id, coalesce(o.q, 0) AS oms_qty_ordered,
                     coalesce(w.q, 0) AS wms_qty_shipped
              FROM (SELECT strftime(order_date, '%Y-%m') AS period, item_id, channel_store_id,
                           sum(qty_ordered) AS q FROM fact_order GROUP BY ALL) o
              FULL JOIN (SELECT strftime(ship_date, '%Y-%m') AS period, item_id,
                                channel_store_id, sum(qty_shipped) AS q FROM fact_shipment
                         WHERE channel_store_id IS NOT NULL GROUP BY ALL) w
                  USING (period, item_id, channel_store_id)) q""",
    "mart_reco_erp_gr_vs_wms_receipt": """
        SELECT period, item_id, po_id, coalesce(e.q, 0) AS erp_qty, coalesce(w.q, 0) AS wms_qty,
               coalesce(e.q, 0) - coalesce(w.q, 0) AS delta
        FROM (SELECT strftime(receipt_date, '%Y-%m') AS period, item_id, po_id,
                     sum(qty_received) AS q FROM fact_receipt
              WHERE upper(source_system) LIKE '%ERP%' AND po_id IS NOT NULL GROUP BY ALL) e
        FULL JOIN (SELECT strftime(receipt_date, '%Y-%m') AS period, item_id, po_id,
                          sum(qty_received) AS q FROM fact_receipt
                   WHERE upper(source_system) LIKE '%WMS%' AND po_id IS NOT NULL GROUP BY ALL) w
            USING (period, item_id, po_id)""",
    "mart_reco_settlement_vs_estimated": """
        SELECT *, CASE WHEN abs(estimated_revenue_krw) > 0
                       THEN delta_krw / abs(estimated_revenue_krw)
                       WHEN delta_krw <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS variance_pct
        FROM (SELECT period, channel_store_id, item_id,
                     coalesce(s.q, 0) AS settlement_revenue_krw,
                     coalesce(e.q, 0) AS estimated_revenue_krw,
                     coalesce(s.q, 0) - coalesce(e.q, 0) AS delta_krw
              FROM (SELECT period, channel_store_id, item_id,
                           sum(net_payout * coalesce(rate_to_krw, 1)) AS q
                    FROM fact_settlement LEFT JOIN fact_exchange_rate USING (period, currency)
                    GROUP BY ALL) s
              FULL JOIN (SELECT period, channel_store_id, item_id, sum(net_revenue_krw) AS q
                         FROM mart_pnl_revenue GROUP BY ALL) e
                  USING (period, channel_store_id, item_id)) q""",
    "mart_reco_charges": """
        SELECT *, abs(delta) < 1e-6 AS tied
        FROM (SELECT period, charge_type, coalesce(i.q, 0) AS invoice_total,
                     coalesce(a.q, 0) AS allocated_total,
                     coalesce(i.q, 0) - coalesce(a.q, 0) AS delta
              FROM (SELECT period, charge_type, sum(amount) AS q FROM fact_charge GROUP BY ALL) i
              FULL JOIN (SELECT period, charge_type, sum(allocated_amount) AS q
                         FROM mart_charge_allocated GROUP BY ALL) a
                  USING (period, charge_type)) q""",
    # ---- constraints --------------------------------------------------------------------
    "sig_late_po": f"""
        SELECT 'supply' AS domain, 'late_po_ratio' AS metric_name,
               round(rate, 4) AS current_value, 0.2::DOUBLE AS threshold_value,
               CASE WHEN rate >= 0.2::DOUBLE * 1.5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
               'supplier' AS entity_type, supplier_id AS entity_id, period
        FROM (SELECT supplier_id, strftime(po_date, '%Y-%m') AS period,
                     sum(CASE WHEN eta_date < {TODAY} AND r.po_id IS NULL THEN 1 ELSE 0 END)
                         / count(*) AS rate
              FROM fact_po LEFT JOIN (SELECT DISTINCT po_id FROM fact_receipt
                                      WHERE po_id IS NOT NULL) r USING (po_id)
              GROUP BY ALL) q
        WHERE rate >= 0.2::DOUBLE""",
    "arrivals": """
        SELECT p.supplier_id, r.warehouse_id, strftime(p.po_date, '%Y-%m') AS po_month,
               strftime(r.receipt_date, '%Y-%m') AS receipt_month,
               r.receipt_date - p.eta_date AS days
        FROM fact_po p JOIN fact_receipt r ON p.po_id = r.po_id AND p.item_id = r.item_id
        WHERE p.eta_date IS NOT NULL""",
    "sig_supplier_delay": """
        SELECT 'supply' AS domain, 'supplier_delay_days' AS metric_name,
               round(d, 1) AS current_value, 7.0::DOUBLE AS threshold_value,
               CASE WHEN d >= 14 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
               'supplier' AS entity_type, supplier_id AS entity_id, period
        FROM (SELECT supplier_id, po_month AS period, avg(days) AS d FROM arrivals
              GROUP BY ALL) q
        WHERE d >= 7""",
    "open_lines": """
        SELECT o.* FROM fact_order o
        ANTI JOIN fact_shipment s
            ON o.channel_order_id = s.channel_order_id AND o.item_id = s.item_id""",
    "sig_backlog": """
        SELECT 'warehouse_3pl' AS domain, 'backlog_ship_orders' AS metric_name,
               CAST(n AS DOUBLE) AS current_value, 30.0::DOUBLE AS threshold_value,
               CASE WHEN n >= 60 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
               'warehouse' AS entity_type, warehouse_id AS entity_id, period
        FROM (SELECT coalesce(ship_from_warehouse_id, 'UNKNOWN') AS warehouse_id,
                     strftime(order_date, '%Y-%m') AS period, count(*) AS n
              FROM open_lines GROUP BY ALL) q
        WHERE n >= 30""",
    "sig_dwell": """
        SELECT 'logistics_customs' AS domain, 'dwell_time_days' AS metric_name,
               round(d, 1) AS current_value, 5.0::DOUBLE AS threshold_value, 'HIGH' AS severity,
               'warehouse' AS entity_type, warehouse_id AS entity_id, period
        FROM (SELECT warehouse_id, receipt_month AS period, avg(days) AS d FROM arrivals
              GROUP BY ALL) q
        WHERE d >= 5""",
    "sig_return_spike": """
        SELECT 'demand_channel' AS domain, 'return_rate_spike' AS metric_name,
               round(rate, 4) AS current_value, 0.01::DOUBLE AS threshold_value,
               'HIGH' AS severity, 'channel' AS entity_type, channel AS entity_id, period
        FROM (SELECT channel, period, returned / coalesce(shipped, 1) AS rate
              FROM (SELECT coalesce(channel_order_id, 'UNKNOWN') AS channel,
                           strftime(return_date, '%Y-%m') AS period,
                           sum(qty_returned) AS returned FROM fact_return GROUP BY ALL) r
              LEFT JOIN (SELECT strftime(ship_date, '%Y-%m') AS period,
                                sum(qty_shipped) AS shipped FROM fact_shipment GROUP BY ALL) s
                  USING (period)) q
        WHERE rate >= 0.01::DOUBLE""",
    "sig_expired": """
        SELECT 'finance' AS domain, 'expired_value_at_risk' AS metric_name,
               sum(expired_qty) AS current_value, 0.0::DOUBLE AS threshold_value,
               'CRITICAL' AS severity, 'item' AS entity_type,
               item_id || '|' || warehouse_id AS entity_id,
               CAST(snapshot_date AS VARCHAR) AS period
        FROM lot_state WHERE expired_qty > 0
        GROUP BY item_id, warehouse_id, snapshot_date""",
    "mart_constraint_signals": """
        SELECT 'SIG-' || upper(substr(sha256(domain || '|' || metric_name || '|' || entity_id
                   || '|' || period), 1, 16)) AS signal_id, *
        FROM (SELECT * FROM sig_late_po UNION ALL SELECT * FROM sig_supplier_delay
              UNION ALL SELECT * FROM sig_backlog UNION ALL SELECT * FROM sig_dwell
              UNION ALL SELECT * FROM sig_return_spike UNION ALL SELECT * FROM sig_expired) s""",
    "signal_rules": """
        SELECT * FROM (VALUES
            ('late_po_ratio', 'Supplier delivery performance below target',
             'Late shipments, capacity constraints',
             'Escalate to procurement; evaluate alternate suppliers', 'HIGH', 'Procurement'),
            ('supplier_delay_days', 'Supplier production delays',
             'Lead time variability, raw material shortage',
             'Negotiate expedited shipping; increase safety stock', 'HIGH', 'Supply Chain'),
            ('backlog_ship_orders', 'Warehouse processing capacity exceeded',
             'Staffing shortage, space constraints',
             'Add temporary labor; prioritize by SLA', 'CRITICAL', 'Warehouse Ops'),
            ('dwell_time_days', 'Port/customs clearance delays',
             'Documentation issues, inspection holds',
             'Pre-clear documentation; engage customs broker', 'MEDIUM', 'Logistics'),
            ('return_rate_spike', 'Product quality or fulfillment errors',
             'Damaged goods, wrong items shipped',
             'Root cause analysis on returns; quality audit', 'HIGH', 'Quality/CS'),
            ('expired_value_at_risk', 'Inventory aging beyond shelf life',
             'Over-ordering, demand forecast error',
             'Markdown/donation plan; adjust reorder parameters', 'CRITICAL', 'Planning'))
            r(metric_name, root_cause, contributing_factors, action, priority, responsible)""",
    # ---- coverage -----------------------------------------------------------------------
    "domain_rows": """
        SELECT 'fx_rate' AS domain, period, count(*) AS n FROM fact_exchange_rate GROUP BY ALL
        UNION ALL
        SELECT 'revenue_settlement', period, count(*) FROM fact_settlement GROUP BY ALL
        UNION ALL
        SELECT 'cost_structure', 'ALL', count(*) FROM fact_cost
        UNION ALL
        SELECT charge_domain, period, count(*)
        FROM fact_charge JOIN policy USING (charge_type) GROUP BY ALL""",
    "known_periods": """
        SELECT strftime(order_date, '%Y-%m') AS period FROM fact_order
        UNION SELECT strftime(ship_date, '%Y-%m') FROM fact_shipment
        UNION SELECT period FROM fact_charge
        UNION SELECT period FROM fact_settlement""",
    "mart_coverage_period": """
        SELECT period, domain,
               CASE WHEN coalesce(n, 0) >= 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                   AS coverage_rate,
               coalesce(n, 0) AS included_rows,
               CAST(CASE WHEN coalesce(n, 0) >= 1 THEN 0 ELSE 1 END AS BIGINT) AS missing_rows,
               CASE WHEN coalesce(n, 0) >= 1 THEN 'OK'
                    WHEN domain = 'fx_rate' OR (closed AND domain IN
                         ('logistics_transport', 'cost_structure')) THEN 'CRITICAL'
                    ELSE 'INFO' END AS severity,
               closed AS is_closed_period
        FROM (SELECT period, period < '1996-01' AS closed, domain
              FROM known_periods
              CROSS JOIN (VALUES ('fx_rate'), ('revenue_settlement'), ('logistics_transport'),
                                 ('customs'), ('3pl_billing'), ('cost_structure')) d(domain)) g
        LEFT JOIN domain_rows USING (domain, period)""",
    # ---- inputs of single operators and dashboards --------------------------------------
    "raw_orders": """
        SELECT 'OMS' AS source_system,
               CASE WHEN (l_partkey + l_suppkey) % 101 <> 0 THEN CAST(l_orderkey AS VARCHAR) END
                   AS channel_order_id,
               CASE WHEN (l_partkey + l_suppkey) % 53 = 0 THEN 'L' ELSE '' END || l_linenumber
                   AS line_no,
               CASE WHEN (l_partkey + l_suppkey) % 67 = 0 THEN 'soon'
                    ELSE CAST(order_date AS VARCHAR) END AS order_date,
               c_mktsegment AS channel_store_id, CAST(l_partkey AS VARCHAR) AS item_id,
               CASE WHEN (l_partkey + l_suppkey) % 31 = 0 THEN 'many'
                    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS qty_ordered,
               'orders_' || c_mktsegment || '.csv' AS file_name
        FROM lines""",
    "quality_results": """
        SELECT file_name, c.check_name, c.severity, CASE c.check_name
                 WHEN 'null_business_key_channel_order_id' THEN null_id
                 WHEN 'duplicate_business_keys' THEN extra
                 WHEN 'type_coercion_line_no' THEN bad_line
                 WHEN 'type_coercion_qty_ordered' THEN bad_qty ELSE 0 END AS bad_rows
        FROM (SELECT file_name, count(*) - count(channel_order_id) AS null_id,
                     count(*) - count(DISTINCT (channel_order_id, line_no)) AS extra,
                     count(*) FILTER (line_no LIKE 'L%') AS bad_line,
                     count(*) FILTER (qty_ordered = 'many') AS bad_qty
              FROM raw_orders GROUP BY file_name) f
        CROSS JOIN (VALUES ('required_columns', 'CRITICAL'),
            ('null_business_key_channel_order_id', 'CRITICAL'),
            ('null_business_key_line_no', 'CRITICAL'), ('duplicate_business_keys', 'HIGH'),
            ('type_coercion_source_system', 'HIGH'), ('type_coercion_channel_order_id', 'HIGH'),
            ('type_coercion_line_no', 'HIGH'), ('type_coercion_order_date', 'HIGH'),
            ('type_coercion_channel_store_id', 'HIGH'), ('type_coercion_item_id', 'HIGH'),
            ('type_coercion_qty_ordered', 'HIGH')) c(check_name, severity)""",
    "latest_cost": """
        SELECT item_id, unit_cost_krw FROM unit_cost
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY effective_from DESC) = 1""",
    "turnover": """
        SELECT item_id, avg_onhand, coalesce(shipped, 0) AS shipped_qty,
               CASE WHEN avg_onhand > 0 THEN coalesce(shipped, 0) / avg_onhand END
                   AS turnover_ratio
        FROM (SELECT item_id, avg(onhand_qty) AS avg_onhand FROM lot_state GROUP BY ALL) o
        LEFT JOIN (SELECT item_id, sum(qty_shipped) AS shipped FROM fact_shipment
                   WHERE channel_order_id IS NOT NULL GROUP BY ALL) s USING (item_id)""",
    "overstock_value": """
        SELECT item_id, warehouse_id, overstock_qty, unit_cost_krw,
               overstock_qty * unit_cost_krw AS overstock_value
        FROM mart_overstock LEFT JOIN latest_cost USING (item_id) WHERE overstock_flag""",
    "basis_totals": """
        SELECT 'order_count' AS basis, CAST(count(DISTINCT channel_order_id) AS DOUBLE) AS q
        FROM fact_order
        UNION ALL SELECT 'line_count', CAST(count(*) AS DOUBLE) FROM fact_order
        UNION ALL SELECT 'qty', sum(qty_shipped) FROM fact_shipment
        UNION ALL SELECT 'weight', sum(weight) FROM fact_shipment
        UNION ALL SELECT 'volume_cbm', sum(volume_cbm) FROM fact_shipment
        UNION ALL SELECT 'value', sum(net_revenue_krw) FROM mart_pnl_revenue
        UNION ALL SELECT 'revenue', sum(net_revenue_krw) FROM mart_pnl_revenue
        UNION ALL SELECT 'onhand_qty_days',
               sum(onhand_qty) / count(DISTINCT snapshot_date) * 30 FROM fact_inventory
        UNION ALL SELECT 'onhand_cbm_days',
               sum(onhand_qty * volume_cbm) / (SELECT count(DISTINCT snapshot_date)
                                               FROM fact_inventory) * 30
        FROM fact_inventory LEFT JOIN dim_item USING (item_id)""",
    "scenario_costs": """
        SELECT scenario, charge_type, cost_stage, unit_price, default_basis AS basis,
               q AS basis_qty, unit_price * q AS estimate
        FROM (SELECT currency AS scenario, charge_type, floor(min(amount) / 1000) AS unit_price
              FROM fact_charge GROUP BY ALL) p
        JOIN policy USING (charge_type) JOIN basis_totals ON default_basis = basis
        WHERE unit_price > 0""",
}

"""The fact mapping of ``tideledger.sources.order_book`` as SQL, one CTE per fact."""

FACTS = {
    "lines": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               l_discount, l_returnflag, l_linestatus, c_mktsegment, c_nationkey, s_nationkey,
               CAST(o_orderdate AS DATE) AS order_date,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                                  l_suppkey, l_quantity, l_extendedprice) AS line_no
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "fact_order": """
        SELECT CAST(l_orderkey AS VARCHAR) AS channel_order_id, line_no, order_date,
               c_mktsegment AS channel_store_id, CAST(l_partkey AS VARCHAR) AS item_id,
               l_quantity AS qty_ordered, CAST(s_nationkey AS VARCHAR) AS ship_from_warehouse_id
        FROM lines""",
    "shipped_lines": """
        SELECT *, order_date + CAST(l_partkey % 8 AS INTEGER) AS ship_date,
               CASE WHEN l_suppkey % 10 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS sales_order,
               CAST(s_nationkey AS VARCHAR) AS warehouse_id,
               CAST(l_partkey AS VARCHAR) AS item_id, CAST(l_suppkey AS VARCHAR) AS lot_id
        FROM lines WHERE l_linestatus = 'F'""",
    "fact_shipment": """
        SELECT 'SHP-' || l_orderkey || '-' || l_linenumber AS shipment_id, ship_date,
               warehouse_id, item_id, l_quantity AS qty_shipped, lot_id,
               CASE WHEN l_partkey % 29 <> 0 THEN l_quantity * p_size END AS weight,
               l_quantity * CAST(0.25 AS DOUBLE) AS volume_cbm,
               sales_order AS channel_order_id,
               CASE WHEN l_partkey % 50 <> 0 THEN c_mktsegment END AS channel_store_id
        FROM shipped_lines JOIN part ON l_partkey = p_partkey""",
    "fact_return": """
        SELECT 'RET-' || l_orderkey || '-' || l_linenumber AS return_id,
               ship_date + 5 AS return_date, warehouse_id, item_id,
               floor(l_quantity / 2 + 1) AS qty_returned, lot_id,
               sales_order AS channel_order_id,
               CASE (l_partkey + l_suppkey) % 4 WHEN 0 THEN 'DAMAGED' WHEN 1 THEN 'WRONG_ITEM'
                    WHEN 2 THEN 'LATE' END AS reason,
               CASE l_partkey % 2 WHEN 0 THEN 'RESTOCK' ELSE 'SCRAP' END AS disposition
        FROM shipped_lines WHERE l_returnflag = 'R'""",
    "fact_inventory": """
        SELECT d.snapshot_date, CAST(s_nationkey AS VARCHAR) AS warehouse_id,
               CAST(l_partkey AS VARCHAR) AS item_id, CAST(l_suppkey AS VARCHAR) AS lot_id,
               CASE WHEN l_partkey % 37 = 0 THEN 0.0::DOUBLE
                    ELSE qty + (l_partkey * d.step) % 7 END AS onhand_qty,
               CASE WHEN l_suppkey % 11 <> 0 THEN DATE '1998-06-01'
                    + CAST((l_partkey * 13 + l_suppkey * 7) % 500 - 40 AS INTEGER)
                    END AS expiry_date,
               CASE (l_partkey + l_suppkey) % 4 WHEN 0 THEN 'Released' WHEN 1 THEN 'released'
                    WHEN 2 THEN 'QUARANTINE' END AS qc_status,
               CASE WHEN (l_partkey + l_suppkey) % 19 <> 0
                    THEN (l_partkey + l_suppkey) % 17 = 0 END AS hold_flag
        FROM (SELECT s_nationkey, l_partkey, l_suppkey, sum(l_quantity) AS qty
              FROM lines GROUP BY ALL) lots
        CROSS JOIN (VALUES (DATE '1998-06-01', 0), (DATE '1998-06-02', 1),
                           (DATE '1998-06-04', 2)) d(snapshot_date, step)""",
    "dim_item": """
        SELECT CAST(p_partkey AS VARCHAR) AS item_id,
               CASE p_partkey % 5 WHEN 0 THEN 'RM' WHEN 1 THEN 'PM' WHEN 2 THEN 'WIP'
                    WHEN 3 THEN 'FG' END AS item_type,
               CASE WHEN p_partkey % 10 = 3 THEN 45 END AS min_sellable_days,
               CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 3 = 0 END AS qc_required_flag,
               CAST(p_size * 0.5 AS DOUBLE) AS volume_cbm
        FROM part WHERE p_size < 50""",
    "dim_warehouse": """
        SELECT CAST(n_nationkey AS VARCHAR) AS warehouse_id, r_name AS warehouse_type,
               n_name AS country
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fact_po": """
        SELECT 'PO-' || l_orderkey AS po_id, order_date AS po_date,
               CAST(min(l_suppkey) AS VARCHAR) AS supplier_id,
               CAST(l_partkey AS VARCHAR) AS item_id, sum(l_quantity) AS qty_ordered,
               CASE WHEN l_partkey % 9 <> 0 THEN order_date + 14 END AS eta_date
        FROM lines GROUP BY l_orderkey, l_partkey, order_date""",
    "fact_receipt": """
        SELECT 'RC-' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS receipt_id,
               order_date + CAST(l_partkey % 25 + 9 AS INTEGER) AS receipt_date,
               CAST(s_nationkey AS VARCHAR) AS warehouse_id,
               CAST(l_partkey AS VARCHAR) AS item_id, l_quantity AS qty_received,
               CASE WHEN l_partkey % 23 <> 0 THEN 'PO-' || l_orderkey END AS po_id,
               CASE l_returnflag WHEN 'A' THEN 'WMS_1' WHEN 'N' THEN 'erp_1'
                    ELSE 'ERP_WMS_BRIDGE' END AS source_system
        FROM lines WHERE l_linestatus = 'F'""",
    "fact_settlement": """
        SELECT 'ST-' || l_orderkey AS settlement_id, line_no,
               strftime(order_date, '%Y-%m') AS period, c_mktsegment AS channel_store_id,
               CASE c_nationkey % 3 WHEN 0 THEN 'KRW' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
               CASE WHEN l_partkey % 31 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS item_id,
               gross_sales, discounts, refunds, gross_sales - discounts - refunds AS net_payout
        FROM (SELECT *, floor(l_extendedprice) AS gross_sales,
                     floor(floor(l_extendedprice) * l_discount) AS discounts,
                     CASE WHEN l_returnflag = 'R' THEN floor(floor(l_extendedprice) / 10)
                          ELSE 0.0::DOUBLE END AS refunds
              FROM lines) priced""",
    "fact_exchange_rate": """
        SELECT period, currency, rate_to_krw FROM (
            SELECT period, 'USD' AS currency, CAST(m * 5 + 1200 AS DOUBLE) AS rate_to_krw,
                   m <> 7 AS known FROM months
            UNION ALL
            SELECT period, 'EUR', CAST(m * 3 + 1400 AS DOUBLE), m <> 11 FROM months) r
        WHERE known""",
    "months": """
        SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS period,
               month(o_orderdate) AS m FROM orders""",
    "fact_cost": """
        SELECT CAST(p_partkey AS VARCHAR) AS item_id, cost_component, effective_from,
               CAST(CASE cost_component WHEN 'MATERIAL' THEN p_size * 100
                         WHEN 'LABOR' THEN p_size * 30 + 7 ELSE p_partkey % 13 + 11 END
                    + p_size * 10 * version AS DOUBLE) AS cost_per_unit_krw
        FROM part
        CROSS JOIN (VALUES ('MATERIAL'), ('LABOR'), ('OVERHEAD')) c(cost_component)
        CROSS JOIN (VALUES (DATE '1994-01-01', 0), (DATE '1998-01-01', 1))
            v(effective_from, version)
        WHERE p_size < 48 AND (p_size > 1 OR version > 0)""",
    "policy": """
        SELECT * FROM (VALUES
            (0, 'LAST_MILE_PARCEL', 'logistics_transport', 'outbound', false, 'order_count'),
            (1, 'DOMESTIC_TRUCKING', 'logistics_transport', 'outbound', false, 'weight'),
            (2, 'FREIGHT_INTL_SEA', 'logistics_transport', 'inbound_landed', true, 'weight'),
            (3, 'FREIGHT_INTL_AIR', 'logistics_transport', 'inbound_landed', true, 'weight'),
            (4, 'PORT_TERMINAL_FEE', 'logistics_transport', 'inbound_landed', true, 'value'),
            (5, 'FORWARDER_FEE', 'logistics_transport', 'inbound_landed', true, 'value'),
            (6, 'CUSTOMS_DUTY', 'customs', 'inbound_landed', true, 'value'),
            (7, 'CUSTOMS_VAT', 'customs', 'inbound_landed', true, 'value'),
            (8, 'BROKER_FEE', 'customs', 'inbound_landed', true, 'value'),
            (9, 'CARGO_INSURANCE', 'logistics_transport', 'inbound_landed', true, 'value'),
            (10, '3PL_STORAGE_FEE', '3pl_billing', 'storage', false, 'onhand_cbm_days'),
            (11, '3PL_PICK_PACK_FEE', '3pl_billing', 'outbound', false, 'line_count'),
            (12, '3PL_HANDLING_FEE', '3pl_billing', 'outbound', false, 'line_count'),
            (13, '3PL_RETURN_PROCESSING_FEE', '3pl_billing', 'returns', false, 'line_count'),
            (14, 'DISPOSAL_FEE', '3pl_billing', 'returns', false, 'qty'),
            (15, 'PLATFORM_FEE', 'platform_fee', 'period', false, 'revenue'),
            (16, 'PG_FEE', 'platform_fee', 'period', false, 'revenue'),
            (17, 'MARKETING_SPEND', 'marketing', 'period', false, 'revenue'))
            p(slot, charge_type, charge_domain, cost_stage, capitalizable_flag, default_basis)""",
    "fact_charge": """
        SELECT 'INV-' || year || '-' || c_nationkey AS invoice_no,
               CAST(1 AS BIGINT) AS invoice_line_no, p.charge_type,
               CAST(total // 10 AS DOUBLE)
                   + CASE WHEN c_nationkey % 8 = 5 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS amount,
               CASE serial % 4 WHEN 2 THEN 'USD' WHEN 3 THEN 'EUR' ELSE 'KRW' END AS currency,
               year || '-' || lpad(CAST(c_nationkey % 12 + 1 AS VARCHAR), 2, '0') AS period,
               CASE WHEN c_nationkey % 5 <> 2 THEN CAST(c_nationkey AS VARCHAR)
                    END AS channel_store_id,
               CASE WHEN c_nationkey = 7 THEN NULL WHEN c_nationkey = 24 THEN 'W99'
                    ELSE CAST(c_nationkey AS VARCHAR) END AS warehouse_id
        FROM (SELECT year(o_orderdate) AS year, c_nationkey,
                     year(o_orderdate) * 25 + c_nationkey AS serial,
                     sum(CAST(floor(o_totalprice) AS BIGINT)) AS total
              FROM orders JOIN customer ON o_custkey = c_custkey
              GROUP BY year(o_orderdate), c_nationkey) t
        JOIN policy p ON serial % 18 = p.slot""",
}

"""Contracts, policies and thresholds as plain driver-side values.

Every number or word list here is a fixed value the results depend on. Functions that use
a threshold take it as an argument and default to the value below.
"""

from __future__ import annotations

from dataclasses import dataclass

# Key sentinel for an absent lot.
NO_LOT = "__NONE__"


@dataclass(frozen=True)
class Contract:
    """Logical ingest contract of one fact table."""

    key: tuple[str, ...]
    event: str
    required: dict[str, str]
    optional: dict[str, str]

    @property
    def columns(self) -> dict[str, str]:
        return {**self.required, **self.optional}


def _cols(text: str) -> dict[str, str]:
    return dict(pair.split(":") for pair in text.split())


# The ten fact contracts (business key, event column, required, optional).
CONTRACTS: dict[str, Contract] = {
    "fact_order": Contract(
        ("channel_order_id", "line_no"), "order_date",
        _cols("source_system:string channel_order_id:string line_no:bigint order_date:date "
              "channel_store_id:string item_id:string qty_ordered:double"),
        _cols("partner_id:string ship_from_warehouse_id:string currency:string source_pk:string"),
    ),
    "fact_shipment": Contract(
        ("shipment_id", "item_id", "lot_id"), "ship_date",
        _cols("source_system:string shipment_id:string ship_date:date warehouse_id:string "
              "item_id:string qty_shipped:double"),
        _cols("lot_id:string weight:double volume_cbm:double channel_order_id:string "
              "channel_store_id:string source_pk:string"),
    ),
    "fact_return": Contract(
        ("return_id", "item_id", "lot_id"), "return_date",
        _cols("source_system:string return_id:string return_date:date warehouse_id:string "
              "item_id:string qty_returned:double"),
        _cols("lot_id:string channel_order_id:string reason:string disposition:string "
              "source_pk:string"),
    ),
    "fact_inventory_snapshot": Contract(
        ("snapshot_date", "warehouse_id", "item_id", "lot_id"), "snapshot_date",
        _cols("source_system:string snapshot_date:date warehouse_id:string item_id:string "
              "lot_id:string onhand_qty:double"),
        _cols("expiry_date:date qc_status:string hold_flag:boolean source_pk:string"),
    ),
    "fact_po": Contract(
        ("po_id", "item_id"), "po_date",
        _cols("source_system:string po_id:string po_date:date supplier_id:string "
              "item_id:string qty_ordered:double"),
        _cols("eta_date:date incoterms:string currency:string unit_price:double "
              "source_pk:string"),
    ),
    "fact_receipt": Contract(
        ("receipt_id", "item_id"), "receipt_date",
        _cols("source_system:string receipt_id:string receipt_date:date warehouse_id:string "
              "item_id:string qty_received:double"),
        _cols("po_id:string lot_id:string expiry_date:date mfg_date:date qc_status:string "
              "source_pk:string"),
    ),
    "fact_settlement": Contract(
        ("settlement_id", "line_no"), "period",
        _cols("source_system:string settlement_id:string line_no:bigint period:string "
              "channel_store_id:string currency:string"),
        _cols("item_id:string gross_sales:double discounts:double fees:double refunds:double "
              "net_payout:double source_pk:string"),
    ),
    "fact_charge_actual": Contract(
        ("invoice_no", "invoice_line_no", "charge_type"), "invoice_date",
        _cols("source_system:string invoice_no:string invoice_line_no:bigint charge_type:string "
              "amount:double currency:string period:string"),
        _cols("invoice_date:date vendor_partner_id:string charge_basis:string "
              "reference_type:string reference_id:string channel_store_id:string "
              "warehouse_id:string country:string source_pk:string"),
    ),
    "fact_exchange_rate": Contract(
        ("period", "currency"), "period",
        _cols("period:string currency:string rate_to_krw:double"), {},
    ),
    "fact_cost_structure": Contract(
        ("item_id", "cost_component", "effective_from"), "effective_from",
        _cols("item_id:string cost_component:string effective_from:date "
              "cost_per_unit_krw:double"), {},
    ),
}

# Columns every stored fact carries beside its contract.
SYSTEM_COLUMNS: dict[str, str] = _cols(
    "source_system:string load_batch_id:bigint source_file_hash:string "
    "source_pk:string loaded_at:timestamp"
)

# Header synonyms, shared ones first.
ALIASES: dict[str, dict[str, list[str]]] = {
    "common": {
        "source_system": ["source_system", "system", "src_system"],
        "source_pk": ["source_pk", "pk", "row_id", "id"],
        "period": ["period", "yyyymm", "year_month", "정산월", "월"],
        "currency": ["currency", "ccy", "통화"],
    },
    "fact_order": {
        "channel_order_id": ["channel_order_id", "order_id", "주문번호"],
        "line_no": ["line_no", "line", "line_number", "라인", "행"],
        "order_date": ["order_date", "ordered_at", "주문일", "주문일자"],
        "channel_store_id": ["channel_store_id", "store_id", "스토어id", "채널스토어"],
        "item_id": ["item_id", "sku", "sku_id", "상품코드", "품목코드", "item_code"],
        "qty_ordered": ["qty_ordered", "order_qty", "주문수량", "수량", "qty"],
    },
    "fact_shipment": {
        "shipment_id": ["shipment_id", "ship_id", "출고번호", "송장번호", "waybill_no"],
        "ship_date": ["ship_date", "shipped_at", "출고일", "출고일자"],
        "warehouse_id": ["warehouse_id", "센터", "창고", "wh_id"],
        "item_id": ["item_id", "sku", "sku_id", "상품코드", "품목코드"],
        "lot_id": ["lot_id", "batch_no", "제조번호", "로트"],
        "qty_shipped": ["qty_shipped", "ship_qty", "출고수량", "수량", "qty"],
        "weight": ["weight", "중량", "kg"],
        "volume_cbm": ["volume_cbm", "cbm", "부피"],
    },
    "fact_inventory_snapshot": {
        "snapshot_date": ["snapshot_date", "date", "기준일", "재고일", "as_of_date"],
        "warehouse_id": ["warehouse_id", "센터", "창고", "wh_id"],
        "item_id": ["item_id", "sku", "sku_id", "상품코드", "품목코드"],
        "lot_id": ["lot_id", "batch_no", "제조번호", "로트"],
        "onhand_qty": ["onhand_qty", "stock_qty", "재고수량", "재고", "qty"],
        "expiry_date": ["expiry_date", "exp_date", "유통기한", "만료일"],
        "qc_status": ["qc_status", "검수상태", "qc"],
        "hold_flag": ["hold_flag", "hold", "보류", "lock_flag"],
    },
    "fact_charge_actual": {
        "invoice_no": ["invoice_no", "청구번호", "invoice", "bill_no"],
        "invoice_line_no": ["invoice_line_no", "line_no", "행", "라인"],
        "invoice_date": ["invoice_date", "청구일", "bill_date"],
        "charge_type": ["charge_type", "비용유형", "수수료유형", "charge"],
        "amount": ["amount", "금액", "cost", "fee_amount"],
        "vendor_partner_id": ["vendor_partner_id", "vendor_id", "공급사id", "3pl_id", "carrier_id"],
        "reference_type": ["reference_type", "ref_type", "참조유형"],
        "reference_id": ["reference_id", "ref_id", "참조id"],
        "channel_store_id": ["channel_store_id", "store_id"],
        "warehouse_id": ["warehouse_id", "센터", "창고"],
        "country": ["country", "국가"],
    },
}

# Charge type, domain, cost stage, capitalizable, default basis, severity if missing.
CHARGE_POLICY: list[tuple[str, str, str, bool, str, str]] = [
    ("LAST_MILE_PARCEL", "logistics_transport", "outbound", False, "order_count", "warn"),
    ("DOMESTIC_TRUCKING", "logistics_transport", "outbound", False, "weight", "warn"),
    ("FREIGHT_INTL_SEA", "logistics_transport", "inbound_landed", True, "weight", "warn"),
    ("FREIGHT_INTL_AIR", "logistics_transport", "inbound_landed", True, "weight", "warn"),
    ("PORT_TERMINAL_FEE", "logistics_transport", "inbound_landed", True, "value", "warn"),
    ("FORWARDER_FEE", "logistics_transport", "inbound_landed", True, "value", "warn"),
    ("CUSTOMS_DUTY", "customs", "inbound_landed", True, "value", "warn"),
    ("CUSTOMS_VAT", "customs", "inbound_landed", True, "value", "warn"),
    ("BROKER_FEE", "customs", "inbound_landed", True, "value", "warn"),
    ("CARGO_INSURANCE", "logistics_transport", "inbound_landed", True, "value", "warn"),
    ("3PL_STORAGE_FEE", "3pl_billing", "storage", False, "onhand_cbm_days", "warn"),
    ("3PL_PICK_PACK_FEE", "3pl_billing", "outbound", False, "line_count", "warn"),
    ("3PL_HANDLING_FEE", "3pl_billing", "outbound", False, "line_count", "warn"),
    ("3PL_RETURN_PROCESSING_FEE", "3pl_billing", "returns", False, "line_count", "warn"),
    ("DISPOSAL_FEE", "3pl_billing", "returns", False, "qty", "warn"),
    ("PLATFORM_FEE", "platform_fee", "period", False, "revenue", "warn"),
    ("PG_FEE", "platform_fee", "period", False, "revenue", "warn"),
    ("MARKETING_SPEND", "marketing", "period", False, "revenue", "warn"),
]

# Allocation rounding and the order in which bases are tried.
ALLOCATION_DECIMALS = 0
BASIS_BY_STAGE: dict[str, list[str]] = {
    "inbound_landed": ["weight", "volume_cbm", "value", "qty"],
    "storage": ["onhand_cbm_days", "onhand_qty_days"],
    "outbound": ["order_count", "line_count", "weight", "qty"],
    "returns": ["line_count", "qty"],
    "period": ["revenue", "line_count"],
}
BASIS_OVERRIDES: dict[str, list[str]] = {
    "3PL_STORAGE_FEE": ["onhand_cbm_days", "onhand_qty_days"],
    "LAST_MILE_PARCEL": ["order_count", "line_count"],
}

# Inventory, expiry, reconciliation and constraint thresholds.
DOH_OVERSTOCK = {"RM": 120, "PM": 180, "WIP": 90, "FG": 90}
DOH_OVERSTOCK_DEFAULT = 90
STOCKOUT_DAYS_COVER = 7
EXPIRY_BUCKETS = [0, 30, 60, 90, 180, 365]
MIN_SELLABLE_DAYS = {"RM": 30, "PM": 90, "FG": 60}
MIN_SELLABLE_DAYS_DEFAULT = 60
PROMISE_DAYS = 3
ADJUSTMENT_RATIO_WARN = 0.01
ADJUSTMENT_RATIO_HIGH = 0.03
LATE_PO_RATIO_HIGH = 0.2
SUPPLIER_DELAY_DAYS_HIGH = 7
BACKLOG_ORDERS_HIGH = 200
DWELL_DAYS_HIGH = 5
RETURN_RATE_HIGH = 1.5
TIE_TOLERANCE = 1e-6

# What each coverage domain needs, and the stricter set once a period is closed.
COVERAGE_DOMAINS: dict[str, str] = {
    "fx_rate": "REQUIRED",
    "revenue_settlement": "OPTIONAL",
    "logistics_transport": "OPTIONAL",
    "customs": "OPTIONAL",
    "3pl_billing": "OPTIONAL",
    "cost_structure": "OPTIONAL",
}
COVERAGE_WHEN_CLOSED: dict[str, str] = {
    "fx_rate": "REQUIRED",
    "logistics_transport": "REQUIRED",
    "cost_structure": "REQUIRED",
}
COVERAGE_MIN_ROWS = 1

# Metric, root cause, contributing factors, action, priority, owner.
SIGNAL_RULES: list[tuple[str, str, str, str, str, str]] = [
    ("late_po_ratio",
     "Supplier delivery performance below target", "Late shipments, capacity constraints",
     "Escalate to procurement; evaluate alternate suppliers", "HIGH", "Procurement"),
    ("supplier_delay_days",
     "Supplier production delays", "Lead time variability, raw material shortage",
     "Negotiate expedited shipping; increase safety stock", "HIGH", "Supply Chain"),
    ("backlog_ship_orders",
     "Warehouse processing capacity exceeded", "Staffing shortage, space constraints",
     "Add temporary labor; prioritize by SLA", "CRITICAL", "Warehouse Ops"),
    ("dwell_time_days",
     "Port/customs clearance delays", "Documentation issues, inspection holds",
     "Pre-clear documentation; engage customs broker", "MEDIUM", "Logistics"),
    ("return_rate_spike",
     "Product quality or fulfillment errors", "Damaged goods, wrong items shipped",
     "Root cause analysis on returns; quality audit", "HIGH", "Quality/CS"),
    ("expired_value_at_risk",
     "Inventory aging beyond shelf life", "Over-ordering, demand forecast error",
     "Markdown/donation plan; adjust reorder parameters", "CRITICAL", "Planning"),
]
SIGNAL_CAUSE_DEFAULT = ("Unknown root cause", "Requires investigation")
SIGNAL_ACTION_DEFAULT = ("Investigate and develop mitigation plan", "MEDIUM", "Operations")

# Waterfall lines in order.
WATERFALL_METRICS = [
    "매출 (Net Revenue)",
    "매출원가 (COGS)",
    "매출총이익 (Gross Margin)",
    "변동비 (Variable Cost)",
    "공헌이익 (Contribution)",
    "영업이익 (Operating Profit)",
]


def basis_priority(charge_type: str) -> list[str]:
    """Bases to try for a charge type: its override, else its stage, else its own default."""
    if charge_type in BASIS_OVERRIDES:
        return BASIS_OVERRIDES[charge_type]
    for name, _, stage, _, basis, _ in CHARGE_POLICY:
        if name == charge_type:
            return BASIS_BY_STAGE.get(stage, [basis])
    raise KeyError(f"Unknown charge type: {charge_type!r}")


def is_domain_required(domain: str, closed: bool = False) -> bool:
    if closed and domain in COVERAGE_WHEN_CLOSED:
        return COVERAGE_WHEN_CLOSED[domain] == "REQUIRED"
    return COVERAGE_DOMAINS.get(domain, "OPTIONAL") == "REQUIRED"

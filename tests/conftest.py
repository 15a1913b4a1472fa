import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tideledger.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


SHIPMENT = ("shipment_id string, ship_date date, warehouse_id string, item_id string, "
            "qty_shipped double, lot_id string, weight double, volume_cbm double, "
            "channel_order_id string, channel_store_id string")
RETURN = ("return_id string, return_date date, warehouse_id string, item_id string, "
          "qty_returned double, lot_id string, channel_order_id string, reason string, "
          "disposition string")
COST = "item_id string, cost_component string, effective_from date, cost_per_unit_krw double"
SETTLEMENT = ("period string, item_id string, channel_store_id string, currency string, "
              "gross_sales double, discounts double, refunds double, net_payout double")
FX = "period string, currency string, rate_to_krw double"
CHARGE = ("invoice_no string, invoice_line_no bigint, charge_type string, amount double, "
          "currency string, period string, channel_store_id string, warehouse_id string")
SNAPSHOT = ("snapshot_date date, warehouse_id string, item_id string, lot_id string, "
            "onhand_qty double, expiry_date date, qc_status string, hold_flag boolean")
ITEM = ("item_id string, item_type string, min_sellable_days int, qc_required_flag boolean")
PO = ("po_id string, po_date date, supplier_id string, item_id string, qty_ordered double, "
      "eta_date date")
RECEIPT = ("receipt_id string, receipt_date date, warehouse_id string, item_id string, "
           "qty_received double, po_id string, source_system string")
ORDER = ("channel_order_id string, line_no bigint, order_date date, channel_store_id string, "
         "item_id string, qty_ordered double, ship_from_warehouse_id string")


def shipment(spark, *lines):
    """Lines of (id, day, item, qty, order, store), all from one warehouse."""
    return spark.createDataFrame(
        [(i, day(d), "WH-01", item, q, "__NONE__", None, None, o, s)
         for i, d, item, q, o, s in lines],
        SHIPMENT,
    )


def returns(spark, *lines):
    return spark.createDataFrame(
        [(i, day(d), "WH-01", item, q, "__NONE__", o, None, None) for i, d, item, q, o in lines],
        RETURN,
    )


def cost(spark, *lines):
    return spark.createDataFrame([(i, c, day(d), v) for i, c, d, v in lines], COST)

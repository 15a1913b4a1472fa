"""Supply-chain facts read from an order book in Parquet (orders, lines, parts, suppliers).

The tables carry no inventory, purchasing, settlement or charge data, so those facts are
derived from the order lines by fixed rules. Quantities and amounts are whole numbers, which
keeps every sum exact in any order of addition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideledger.functions.columns import month_key

AS_OF_DATE = dt.date(2001, 12, 31)

# Snapshot days (two in a row, then a gap) and the unit-cost versions.
SNAPSHOT_DAYS = [dt.date(1998, 6, 1), dt.date(1998, 6, 2), dt.date(1998, 6, 4)]
COST_DATES = [dt.date(1994, 1, 1), dt.date(1998, 1, 1)]
# Charge types in the order in which charges cycle through them.
CHARGE_CYCLE = [
    "LAST_MILE_PARCEL", "DOMESTIC_TRUCKING", "FREIGHT_INTL_SEA", "FREIGHT_INTL_AIR",
    "PORT_TERMINAL_FEE", "FORWARDER_FEE", "CUSTOMS_DUTY", "CUSTOMS_VAT", "BROKER_FEE",
    "CARGO_INSURANCE", "3PL_STORAGE_FEE", "3PL_PICK_PACK_FEE", "3PL_HANDLING_FEE",
    "3PL_RETURN_PROCESSING_FEE", "DISPOSAL_FEE", "PLATFORM_FEE", "PG_FEE", "MARKETING_SPEND",
]


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _cycle(index: Column, values: list[str | None]) -> Column:
    """values[index mod n]."""
    choices = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(choices, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def _none_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


class OrderBook:
    """Lazy fact and dimension DataFrames over one directory of Parquet tables.

    ``keep`` stores the four frames that cost a join or an aggregation of all lines, as a
    warehouse would, and the few exchange rates; the other facts are projections of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
    ):
        self.spark = spark
        self.folder = folder
        self.keep = keep

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with order date, market segment, customer and supplier nation."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        customer = self.table("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        lineitem = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
        )
        # A line stays if its customer or supplier is missing. Orders, which are fewer than lines, meet
        # their customers first; lines then move once by order key, for the join and the line numbers.
        bought = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        joined = (
            lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("order_date", F.to_date("o_orderdate"))
            .withColumn("line_no", self._line_no())
            .drop("o_orderkey", "o_custkey", "o_orderdate", "c_custkey", "s_suppkey")
        )
        return self.keep(joined, "order-lines")

    @cached_property
    def order(self) -> DataFrame:
        return self.lines.select(
            _text("l_orderkey").alias("channel_order_id"),
            "line_no",
            "order_date",
            F.col("c_mktsegment").alias("channel_store_id"),
            _text("l_partkey").alias("item_id"),
            F.col("l_quantity").alias("qty_ordered"),
            _text("s_nationkey").alias("ship_from_warehouse_id"),
        )

    @staticmethod
    def _line_no() -> Column:
        """Line number made unique: the source repeats numbers within an order. An order's lines
        are few, so its window is small."""
        in_order = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
        )
        return F.row_number().over(in_order).cast("bigint")

    @cached_property
    def shipped_lines(self) -> DataFrame:
        transfer = F.col("l_suppkey") % 10 == 0
        return self.lines.where(F.col("l_linestatus") == "F").withColumns(
            {
                "ship_date": F.date_add("order_date", (F.col("l_partkey") % 8).cast("int")),
                "sales_order": _none_when(transfer, _text("l_orderkey")),
                "warehouse_id": _text("s_nationkey"),
                "item_id": _text("l_partkey"),
                "lot_id": _text("l_suppkey"),
            }
        )

    @cached_property
    def shipment(self) -> DataFrame:
        part = self.table("part").select("p_partkey", "p_size")
        shipped = self.shipped_lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.concat_ws("-", F.lit("SHP"), "l_orderkey", "l_linenumber").alias("shipment_id"),
            "ship_date", "warehouse_id", "item_id",
            F.col("l_quantity").alias("qty_shipped"),
            "lot_id",
            _none_when(F.col("l_partkey") % 29 == 0, F.col("l_quantity") * F.col("p_size")).alias(
                "weight"
            ),
            (F.col("l_quantity") * 0.25).alias("volume_cbm"),
            F.col("sales_order").alias("channel_order_id"),
            _none_when(F.col("l_partkey") % 50 == 0, F.col("c_mktsegment")).alias(
                "channel_store_id"
            ),
        )
        return self.keep(shipped, "shipments")

    @cached_property
    def returns(self) -> DataFrame:
        reasons = ["DAMAGED", "WRONG_ITEM", "LATE", None]
        return self.shipped_lines.where(F.col("l_returnflag") == "R").select(
            F.concat_ws("-", F.lit("RET"), "l_orderkey", "l_linenumber").alias("return_id"),
            F.date_add("ship_date", 5).alias("return_date"),
            "warehouse_id", "item_id",
            F.floor(F.col("l_quantity") / 2 + 1).cast("double").alias("qty_returned"),
            "lot_id",
            F.col("sales_order").alias("channel_order_id"),
            _cycle(F.col("l_partkey") + F.col("l_suppkey"), reasons).alias("reason"),
            _cycle(F.col("l_partkey"), ["RESTOCK", "SCRAP"]).alias("disposition"),
        )

    @cached_property
    def lots(self) -> DataFrame:
        lots = self.lines.groupBy("s_nationkey", "l_partkey", "l_suppkey").agg(
            F.sum("l_quantity").alias("qty")
        )
        return self.keep(lots, "lots")

    @cached_property
    def inventory(self) -> DataFrame:
        """The lots on each snapshot day: a projection, so that days are not stored."""
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        days = F.array(
            *[
                F.struct(F.lit(d).alias("snapshot_date"), F.lit(n).alias("step"))
                for n, d in enumerate(SNAPSHOT_DAYS)
            ]
        )
        expiry = F.date_add(F.lit(SNAPSHOT_DAYS[0]), ((part * 13 + supp * 7) % 500 - 40).cast("int"))
        moved = F.col("qty") + F.pmod(part * F.col("step"), F.lit(7))
        return self.lots.select("*", F.explode(days).alias("d")).select("*", "d.*").select(
            "snapshot_date",
            _text("s_nationkey").alias("warehouse_id"),
            _text(part).alias("item_id"),
            _text(supp).alias("lot_id"),
            F.when(part % 37 == 0, F.lit(0.0)).otherwise(moved.cast("double")).alias("onhand_qty"),
            _none_when(supp % 11 == 0, expiry).alias("expiry_date"),
            _cycle(part + supp, ["Released", "released", "QUARANTINE", None]).alias("qc_status"),
            F.when((part + supp) % 19 == 0, F.lit(None).cast("boolean"))
            .otherwise((part + supp) % 17 == 0)
            .alias("hold_flag"),
        )

    @cached_property
    def item(self) -> DataFrame:
        key = F.col("p_partkey")
        # The item master lags behind: parts of the largest size are not in it yet.
        return self.table("part").where(F.col("p_size") < 50).select(
            _text(key).alias("item_id"),
            _cycle(key, ["RM", "PM", "WIP", "FG", None]).alias("item_type"),
            F.when(key % 10 == 3, F.lit(45)).alias("min_sellable_days"),
            _none_when(key % 7 == 0, key % 3 == 0).alias("qc_required_flag"),
            (F.col("p_size") * 0.5).cast("double").alias("volume_cbm"),
        )

    @cached_property
    def warehouse(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return (
            nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                _text("n_nationkey").alias("warehouse_id"),
                F.col("r_name").alias("warehouse_type"),
                F.col("n_name").alias("country"),
            )
        )

    @cached_property
    def po(self) -> DataFrame:
        grouped = self.lines.groupBy("l_orderkey", "l_partkey", "order_date").agg(
            F.min("l_suppkey").alias("supplier"), F.sum("l_quantity").alias("qty_ordered")
        )
        orders = grouped.select(
            F.concat(F.lit("PO-"), _text("l_orderkey")).alias("po_id"),
            F.col("order_date").alias("po_date"),
            _text("supplier").alias("supplier_id"),
            _text("l_partkey").alias("item_id"),
            "qty_ordered",
            _none_when(F.col("l_partkey") % 9 == 0, F.date_add("order_date", 14)).alias(
                "eta_date"
            ),
        )
        return self.keep(orders, "purchase-orders")

    @cached_property
    def receipt(self) -> DataFrame:
        wait = (F.col("l_partkey") % 25 + 9).cast("int")
        systems = {"A": "WMS_1", "N": "erp_1", "R": "ERP_WMS_BRIDGE"}
        flag = F.col("l_returnflag")
        system = F.when(flag == "A", F.lit(systems["A"])).when(flag == "N", F.lit(systems["N"]))
        return self.lines.where(F.col("l_linestatus") == "F").select(
            F.concat_ws("-", F.lit("RC"), "l_orderkey", "l_linenumber", "l_suppkey").alias(
                "receipt_id"
            ),
            F.date_add("order_date", wait).alias("receipt_date"),
            _text("s_nationkey").alias("warehouse_id"),
            _text("l_partkey").alias("item_id"),
            F.col("l_quantity").alias("qty_received"),
            _none_when(
                F.col("l_partkey") % 23 == 0, F.concat(F.lit("PO-"), _text("l_orderkey"))
            ).alias("po_id"),
            system.otherwise(F.lit(systems["R"])).alias("source_system"),
        )

    @cached_property
    def settlement(self) -> DataFrame:
        priced = self.lines.withColumn("gross_sales", F.floor("l_extendedprice").cast("double"))
        off = F.floor(F.col("gross_sales") * F.col("l_discount")).cast("double")
        back = F.when(F.col("l_returnflag") == "R", F.floor(F.col("gross_sales") / 10))
        money = priced.withColumns(
            {"discounts": off, "refunds": back.otherwise(F.lit(0)).cast("double")}
        )
        return money.select(
            F.concat(F.lit("ST-"), _text("l_orderkey")).alias("settlement_id"),
            "line_no",
            month_key("order_date").alias("period"),
            F.col("c_mktsegment").alias("channel_store_id"),
            _cycle(F.col("c_nationkey"), ["KRW", "USD", "EUR"]).alias("currency"),
            _none_when(F.col("l_partkey") % 31 == 0, _text("l_partkey")).alias("item_id"),
            "gross_sales", "discounts", "refunds",
            (F.col("gross_sales") - F.col("discounts") - F.col("refunds")).alias("net_payout"),
        )

    @cached_property
    def exchange_rate(self) -> DataFrame:
        months = (
            self.table("orders")
            .select(month_key(F.to_date("o_orderdate")).alias("period"))
            .distinct()
            .withColumn("m", F.substring("period", 6, 2).cast("int"))
        )
        rates = F.array(
            F.struct(
                F.lit("USD").alias("currency"),
                (F.col("m") * 5 + 1200).cast("double").alias("rate_to_krw"),
                (F.col("m") != 7).alias("known"),
            ),
            F.struct(
                F.lit("EUR").alias("currency"),
                (F.col("m") * 3 + 1400).cast("double").alias("rate_to_krw"),
                (F.col("m") != 11).alias("known"),
            ),
        )
        known = months.select("period", F.explode(rates).alias("r")).select("period", "r.*").where("known")
        # Two rows a month: stored, so that their size is known and no line moves to them.
        return self.keep(known.drop("known"), "exchange-rates")

    @cached_property
    def cost(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        parts = {"MATERIAL": size * 100, "LABOR": size * 30 + 7, "OVERHEAD": key % 13 + 11}
        entries = F.array(
            *[
                F.struct(
                    F.lit(name).alias("cost_component"),
                    F.lit(day).alias("effective_from"),
                    (value + size * 10 * n).cast("double").alias("cost_per_unit_krw"),
                    F.lit(n).alias("version"),
                )
                for name, value in parts.items()
                for n, day in enumerate(COST_DATES)
            ]
        )
        # Sizes 48 and up are not costed; the smallest size only since the second version.
        return (
            self.table("part")
            .where(size < 48)
            .select("p_partkey", "p_size", F.explode(entries).alias("c"))
            .select("p_partkey", "p_size", "c.*")
            .where((size > 1) | (F.col("version") > 0))
            .select(
                _text(key).alias("item_id"), "cost_component", "effective_from",
                "cost_per_unit_krw",
            )
        )

    @cached_property
    def charge(self) -> DataFrame:
        """One charge per order year and customer nation."""
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        totals = (
            self.table("orders")
            .select("o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("year", "c_nationkey")
            .agg(F.sum(F.floor("o_totalprice")).alias("total"))
        )
        nation, serial = F.col("c_nationkey"), F.col("year") * 25 + F.col("c_nationkey")
        half = F.when(nation % 8 == 5, F.lit(0.5)).otherwise(F.lit(0.0))
        month = F.lpad((nation % 12 + 1).cast("string"), 2, "0")
        return totals.select(
            F.concat_ws("-", F.lit("INV"), "year", "c_nationkey").alias("invoice_no"),
            F.lit(1).cast("bigint").alias("invoice_line_no"),
            _cycle(serial, CHARGE_CYCLE).alias("charge_type"),
            (F.floor(F.col("total") / 10) + half).cast("double").alias("amount"),
            _cycle(serial, ["KRW", "KRW", "USD", "EUR"]).alias("currency"),
            F.concat_ws("-", "year", month).alias("period"),
            _none_when(nation % 5 == 2, F.col("c_nationkey").cast("string")).alias(
                "channel_store_id"
            ),
            F.when(nation == 7, F.lit(None).cast("string"))
            .when(nation == 24, F.lit("W99"))
            .otherwise(nation.cast("string"))
            .alias("warehouse_id"),
        )

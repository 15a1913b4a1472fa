import datetime as dt

import pytest

from tideledger.sources.order_book import SNAPSHOT_DAYS, OrderBook


@pytest.fixture
def folder(spark, tmp_path):
    day = dt.datetime(1995, 3, 1)
    tables = {
        "customer": ("c_custkey long, c_mktsegment string, c_nationkey int", [(1, "A", 3)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 4)]),
        "part": ("p_partkey long, p_size int", [(n, n) for n in range(1, 4)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double",
                   [(1, 1, day, 10.0), (2, 9, day, 10.0), (3, None, day, 10.0)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string",
                     [(o, p, s, 1, 5.0, 7.0, 0.0, "R", "F")
                      for o in (1, 2, 3, 4, None) for p, s in ((1, 1), (2, 1), (3, 8), (4, None))]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lines_move_once_by_order_and_stay_without_customer_or_supplier(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lines = OrderBook(spark, folder).lines
        plan = lines._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.l_orderkey, r.line_no, r.l_partkey, r.c_nationkey, r.s_nationkey)
                     for r in lines.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    assert [r[:3] for r in got] == [(o, n, n) for o in (1, 2, 3) for n in (1, 2, 3, 4)]
    assert [r[3] for r in got] == [3] * 4 + [None] * 8
    assert [r[4] for r in got] == [4, 4, None, None] * 3


def test_shipments_and_lots_are_kept_and_snapshot_days_are_not(spark, folder):
    kept = {}
    book = OrderBook(spark, folder, keep=lambda df, name: kept.setdefault(name, df))
    # Parts without a row ship nothing.
    assert book.shipment.count() == 9 and "shipments" in kept
    days = len(SNAPSHOT_DAYS)
    assert book.inventory.count() == days * kept["lots"].count() == days * 4
    assert "inventory-snapshots" not in kept


def test_exchange_rates_are_stored_once(spark, folder):
    kept = {}
    book = OrderBook(spark, folder, keep=lambda df, name: kept.setdefault(name, df))
    assert sorted(tuple(r) for r in book.exchange_rate.collect()) == [
        ("1995-03", "EUR", 1409.0), ("1995-03", "USD", 1215.0)]
    assert kept["exchange-rates"] is book.exchange_rate

import tempfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import day, rows
from tideledger.plans import operations as ops
from tideledger.plans import quality
from tideledger.sources import headers
from tideledger.sources.inbox import ingest
from tideledger.sources.warehouse import Warehouse

ORDERS = """source_system,channel_order_id,line_no,order_date,channel_store_id,item_id,qty_ordered
OMS,ORD-001,1,2024-01-15,STORE-A,SKU-001,10
OMS,ORD-002,1,2024-01-16,STORE-A,SKU-002,20
"""
KOREAN = """system,주문번호,라인,주문일,스토어id,상품코드,주문수량
OMS,ORD-002,1,2024-02-16,STORE-A,SKU-002,25
OMS,ORD-003,1,2024-02-17,STORE-A,SKU-003,30
"""
SHIPMENTS = """source_system,shipment_id,ship_date,warehouse_id,item_id,qty_shipped,channel_order_id,store
WMS,SHP-001,2024-01-16,WH-01,SKU-001,10,ORD-001,x
"""
CHARGES = """system,청구번호,행,비용유형,금액,통화,정산월
ERP,INV-001,1,LAST_MILE_PARCEL,1000,KRW,2024-01
"""
COSTS = """item_id,cost_component,effective_from,cost_per_unit_krw
SKU-001,MATERIAL,2024-01-01,5000
SKU-001,MATERIAL,2024-02-01,5500
"""
AS_OF = day("2024-06-01")
_number = iter(range(1000))


@pytest.fixture
def box(spark):
    """An empty warehouse with its own database names, and an inbox folder."""
    root = tempfile.mkdtemp(prefix="run-")
    inbox = Path(root) / "inbox"
    inbox.mkdir()
    return Warehouse(spark, f"{root}/tables", f"t{next(_number)}_"), inbox


def put(inbox, **files):
    for name, text in files.items():
        (inbox / f"{name}.csv").write_text(text, encoding="utf-8")


def status(outcomes):
    return {o["file_name"]: o["status"] for o in outcomes.collect()}


def test_headers_route_to_their_fact():
    assert headers.detect_table(ORDERS.splitlines()[0].split(",")) == "fact_order"
    assert headers.detect_table(KOREAN.splitlines()[0].split(",")) == "fact_order"
    assert headers.detect_table(SHIPMENTS.splitlines()[0].split(",")) == "fact_shipment"
    assert headers.canonical_names([" 주문번호 ", "Qty", "other"], "fact_order") == [
        "channel_order_id", "qty_ordered", "other"]
    with pytest.raises(ValueError):
        headers.detect_table(["foo", "bar"])


def test_each_fault_fails_its_check(spark):
    names = ORDERS.splitlines()[0].split(",") + ["file_name"]
    schema = ", ".join(f"{n} string" for n in names)
    lines = [("OMS", "O1", "1", "2024-01-15", "A", "I", "10", "good"),
             ("OMS", None, "1", "2024-01-15", "A", "I", "10", "null"),
             ("OMS", "O1", "1", "soon", "A", "I", "10", "twice"),
             ("OMS", "O1", "1", "2024-01-15", "A", "I", "11", "twice"),
             ("OMS", "O1", "1.5", "2024-01-15", "A", "I", "ten", "cast")]
    results = quality.check_files(spark.createDataFrame(lines, schema), "fact_order")
    assert rows(quality.failures(results), "file_name", "check_name", "bad_rows") == [
        ("cast", "type_coercion_line_no", 1), ("cast", "type_coercion_qty_ordered", 1),
        ("null", "null_business_key_channel_order_id", 1),
        ("twice", "duplicate_business_keys", 1)]
    short = spark.createDataFrame([("O1", "f")], "channel_order_id string, file_name string")
    missing = quality.failures(quality.check_files(short, "fact_order")).first()
    assert missing.check_name == "required_columns" and "order_date" in missing.detail
    charges = spark.createDataFrame(
        [("I1", "1", t, "f") for t in ("PG_FEE", "BAD_FEE", None)],
        "invoice_no string, invoice_line_no string, charge_type string, file_name string")
    unknown = quality.unknown_charge_types(charges, "file_name").where("NOT passed")
    assert rows(unknown, "detail") == [("Unknown charge type not in policy: BAD_FEE",),
                                       ("Unknown charge type not in policy: None",)]


def test_casts_are_lenient(spark):
    df = spark.createDataFrame([("YES", "2024-01-05", "x"), ("0", "2024-13-05", "1.5"),
                                ("maybe", None, " 2")], "b string, d string, n string")
    got = df.select(quality.cast_value(F.col("b"), "boolean").alias("b"),
                    quality.cast_value(F.col("d"), "date").alias("d"),
                    quality.cast_value(F.col("n"), "double").alias("n"))
    assert [tuple(r) for r in got.collect()] == [
        (True, day("2024-01-05"), None), (False, None, 1.5), (None, None, 2.0)]


def test_inbox_is_loaded_once_and_later_files_win(box):
    wh, inbox = box
    put(inbox, a=ORDERS, b=KOREAN, c=SHIPMENTS, d="foo,bar\n1,2\n", e=ORDERS.splitlines()[0] + "\n",
        f=ORDERS.replace("ORD-002,1", "ORD-001,1"), g=ORDERS)
    first = status(ingest(wh, str(inbox), 1))
    assert first == {"a.csv": "success", "b.csv": "success", "c.csv": "success", "d.csv": "error",
                     "e.csv": "skipped", "f.csv": "dq_failed", "g.csv": "skipped"}
    want = [("ORD-001", day("2024-01-15"), 10.0), ("ORD-002", day("2024-02-16"), 25.0),
            ("ORD-003", day("2024-02-17"), 30.0)]
    assert rows(wh.order, "channel_order_id", "order_date", "qty_ordered") == want
    assert rows(wh.shipment, "lot_id", "channel_store_id") == [("__NONE__", None)]
    again = status(ingest(wh, str(inbox), 2))
    assert again["a.csv"] == again["b.csv"] == again["c.csv"] == "skipped"
    assert rows(wh.order, "channel_order_id", "order_date", "qty_ordered") == want
    assert wh.read("raw", "system_dq_report").where("NOT passed").count() > 0


def test_file_names_with_encodable_characters(box):
    wh, inbox = box
    names = ["orders one", "a%20b", "a#1", "a+b", "주문"]
    for i, name in enumerate(names):
        put(inbox, **{name: ORDERS.replace("ORD-", f"ORD{i}-")})
    assert status(ingest(wh, str(inbox), 1)) == {f"{n}.csv": "success" for n in names}


def test_required_columns_need_values(box):
    wh, inbox = box
    put(inbox, a=ORDERS, b=ORDERS.replace("ORD-", "X-").replace("2024-01-15", "soon"),
        c=ORDERS.replace("ORD-", "Y-").replace("SKU-001,10", "SKU-001,"))
    assert status(ingest(wh, str(inbox), 1)) == {
        "a.csv": "success", "b.csv": "dq_failed", "c.csv": "dq_failed"}
    assert set(rows(wh.order, "channel_order_id")) == {("ORD-001",), ("ORD-002",)}


def test_a_quoted_field_may_hold_a_line_break(box):
    wh, inbox = box
    put(inbox, a=ORDERS.replace("SKU-001", '"SKU\n001"'))
    assert status(ingest(wh, str(inbox), 1)) == {"a.csv": "success"}
    assert set(rows(wh.order, "item_id")) == {("SKU\n001",), ("SKU-002",)}


def test_an_upsert_moves_a_row_between_months(box):
    wh, inbox = box
    put(inbox, a=ORDERS)
    ingest(wh, str(inbox), 1)
    put(inbox, b=ORDERS.replace("2024-01-15", "2024-03-15").replace("2024-01-16", "2024-03-16"))
    ingest(wh, str(inbox), 2)
    assert rows(wh.order, "order_date") == [(day("2024-03-15"),), (day("2024-03-16"),)]


def test_an_upsert_reads_the_months_that_may_hold_its_keys(box):
    wh, inbox = box
    head, line = ORDERS.splitlines()[0], "OMS,ORD-{i},1,2024-{m:02}-15,STORE-A,SKU-001,{q}"
    lines = [line.format(i=i, m=i % 12 + 1, q=1) for i in range(240)]
    put(inbox, a="\n".join([head, *lines]))
    ingest(wh, str(inbox), 1)
    mine = wh.spark.createDataFrame([(f"ORD-{i}", 1) for i in (2, 14, 26)], "channel_order_id string, line_no bigint")
    assert wh.months_with_keys("fact_order", mine) == ["2024-03"]
    several = wh.spark.createDataFrame([("ORD-2", 1), ("ORD-7", 1)], "channel_order_id string, line_no bigint")
    assert wh.months_with_keys("fact_order", several) == ["2024-03", "2024-08"]
    unknown = wh.spark.createDataFrame([("ORD-2", 9)], "channel_order_id string, line_no bigint")
    assert wh.months_with_keys("fact_order", unknown) == []
    # Keys move to another month, in which they are found from then on.
    put(inbox, b="\n".join([head, line.format(i=2, m=6, q=5), line.format(i=900, m=6, q=5)]))
    ingest(wh, str(inbox), 2)
    assert wh.months_with_keys("fact_order", several) == ["2024-06", "2024-08"]
    assert wh.order.count() == 241 and wh.order.where("qty_ordered = 5").count() == 2
    wh.remove_batches("fact_order", [2])
    assert wh.order.count() == 239
    assert wh.months_with_keys("fact_order", several) == ["2024-08"]


def test_dry_run_leaves_the_file_loadable(box):
    wh, inbox = box
    put(inbox, a=ORDERS)
    assert ops.run_pipeline(wh, str(inbox), AS_OF, dry_run=True)["marts"] == {}
    assert wh.order.isEmpty()
    assert status(ingest(wh, str(inbox), 2)) == {"a.csv": "success"}


def test_pipeline_rollback_and_status(box):
    wh, inbox = box
    put(inbox, a=ORDERS, c=SHIPMENTS, d=CHARGES, e=COSTS)
    run = ops.run_pipeline(wh, str(inbox), AS_OF)
    assert set(run["marts"].values()) == {"ok"} and run["batch_id"] == 1
    assert "mart_constraint_effectiveness" in run["marts"]
    mart = wh.read("mart", "mart_pnl_cogs")
    assert rows(mart, "item_id", "unit_cost_krw", "cogs_krw") == [("SKU-001", 5000.0, 50000.0)]
    tied = wh.read("mart", "mart_reco_charges_invoice_vs_allocated")
    assert rows(tied, "allocated_total", "tied") == [(1000.0, True)]
    assert ops.last_batch(wh).first().status == "success"
    counts = {r.table_name: r.row_count for r in wh.row_counts().collect()}
    assert counts["core.fact_order"] == 2 and counts["core.fact_cost_structure"] == 2
    assert ops.rollback_batches(wh, 1, AS_OF) == [1]
    assert wh.order.isEmpty() and wh.read("mart", "mart_pnl_cogs").isEmpty()
    assert ops.last_batch(wh).first().status == "rolled_back"
    assert set(status(ingest(wh, str(inbox), 2)).values()) == {"success"}


def test_row_counts_leave_out_views_of_the_session(box, spark):
    wh, inbox = box
    put(inbox, a=ORDERS)
    ingest(wh, str(inbox), 1)
    spark.range(1).createOrReplaceTempView("counted_view")
    try:
        names = {r.table_name for r in wh.row_counts().collect()}
    finally:
        spark.catalog.dropTempView("counted_view")
    assert "core.fact_order" in names and not any("counted_view" in n for n in names)


def test_refresh_leaves_out_views_of_the_session(box, spark):
    wh, _ = box
    spark.range(1).createOrReplaceTempView("refreshed_view")
    try:
        wh.refresh()
    finally:
        spark.catalog.dropTempView("refreshed_view")


def test_period_close(box):
    wh, inbox = box
    assert not ops.is_period_closed(wh, "2024-01")
    ops.close_period(wh, "2024-01", "me")
    ops.close_period(wh, "2024-01", "you")
    assert rows(ops.closed_periods(wh), "period") == [("2024-01",)]
    with pytest.raises(ValueError, match="closed"):
        ops.check_period_for_ingestion(wh, "2024-01")
    assert any("fx_rate" in r.message for r in ops.closed_period_errors(wh, "2024-01").collect())
    put(inbox, a=ORDERS)
    assert status(ingest(wh, str(inbox), 1, reject_closed=True)) == {"a.csv": "error"}
    assert ops.post_close_adjustment(wh, "2024-01", "fact_order", "O|1", "qty", "10", "12", "r", "me") == 1
    assert ops.post_close_adjustment(wh, "2024-01", "fact_order", "O|1", "qty", "12", "13", "r", "me") == 2
    assert rows(ops.adjustments(wh, "2024-01"), "adjustment_id", "old_value", "new_value") == [
        (1, "10", "12"), (2, "12", "13")]
    ops.reopen_period(wh, "2024-01", "fix")
    ops.check_period_for_ingestion(wh, "2024-01")
    assert status(ingest(wh, str(inbox), 2)) == {"a.csv": "success"}


def test_concurrent_claims_get_ids_of_their_own(box):
    wh, _ = box
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: wh.claim("batch", 1), range(40)))
    assert sorted(numbers) == list(range(1, 41))
    assert wh.claim("other", 7) == 7 and wh.claim("other", 3) == 3
    # A run that has claimed its id but not logged it yet does not give it to the next one.
    assert [ops.start_batch(wh), ops.start_batch(wh)] == [41, 42]


def test_policy_dimension(box):
    wh, _ = box
    ops.seed_charge_policy(wh)
    assert wh.spark.table(wh.name("core", "dim_charge_policy")).count() == 18

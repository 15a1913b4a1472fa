from conftest import ORDER, PO, RECEIPT, RETURN, SNAPSHOT, ITEM, CHARGE, COST, FX, SETTLEMENT
from conftest import day, rows, shipment
from tideledger.plans import boards, constraint, coverage, reco, registry, scm
from tideledger.plans.marts import Marts

TODAY = day("2024-06-01")


def po(spark, *lines):
    return spark.createDataFrame(
        [(p, day("2024-01-05"), s, i, 10.0, e and day(e)) for p, s, i, e in lines], PO)


def receipt(spark, *lines):
    return spark.createDataFrame(
        [(r, day(d), "WH", i, q, p, src) for r, d, i, q, p, src in lines], RECEIPT)


def order(spark, *lines):
    return spark.createDataFrame(
        [(o, n, day(d), s, i, q, w) for o, n, d, s, i, q, w in lines], ORDER)


def test_late_po_is_critical_and_looks_at_whole_pos(spark):
    late = po(spark, *[(f"P{n}", "SUP-001", "I", "2024-01-10") for n in range(5)])
    none = receipt(spark)
    found = constraint.late_po(late, none, TODAY)
    assert rows(found, "entity_id", "current_value", "severity") == [("SUP-001", 1.0, "CRITICAL")]
    assert rows(constraint.late_po(late, none, TODAY), "signal_id") == rows(found, "signal_id")
    other_line = receipt(spark, *[(f"R{n}", "2024-01-09", "OTHER", 1.0, f"P{n}", "WMS")
                                  for n in range(5)])
    assert constraint.late_po(late, other_line, TODAY).isEmpty()


def test_delays_are_averaged_over_receipts(spark):
    lines = po(spark, ("P1", "S", "I", "2024-01-10"), ("P2", "S", "I", None))
    got = receipt(spark, ("R1", "2024-01-20", "I", 1.0, "P1", "WMS"),
                  ("R2", "2024-01-15", "I", 1.0, "P1", "WMS"),
                  ("R3", "2024-05-15", "I", 1.0, "P2", "WMS"))
    assert rows(constraint.supplier_delay(lines, got), "current_value", "severity") == [
        (7.5, "HIGH")]
    assert rows(constraint.dwell_time(lines, got), "entity_id", "current_value", "period") == [
        ("WH", 7.5, "2024-01")]


def test_backlog_default_threshold(spark):
    lines = order(spark, *[(f"O{n}", 1, "2024-01-01", "A", "I", 1.0, None) for n in range(400)])
    ship = shipment(spark, *[(f"S{n}", "2024-01-02", "I", 1.0, f"O{n}", "A") for n in range(100)])
    assert rows(constraint.backlog(lines, ship), "entity_id", "current_value", "severity") == [
        ("UNKNOWN", 300.0, "HIGH")]
    assert rows(boards.backlog_totals(lines, ship), "open_orders", "open_qty") == [(300, 300.0)]


def test_return_spike_default_threshold(spark):
    ship = shipment(spark, ("S1", "2024-01-02", "I", 10.0, "O1", "A"))
    back = spark.createDataFrame(
        [("R1", day("2024-01-03"), "WH", "I", 15.0, "L", None, None, None),
         ("R2", day("2024-03-03"), "WH", "I", 1.0, "L", "O1", None, None)], RETURN)
    assert rows(constraint.return_spike(back, ship), "entity_id", "current_value") == [
        ("UNKNOWN", 1.5)]


def test_expired_stock_makes_an_issue_with_cause_and_action(spark):
    snap = spark.createDataFrame(
        [(TODAY, "WH", "I", "L", 100.0, day("2024-05-01"), None, False)], SNAPSHOT)
    item = spark.createDataFrame([], ITEM)
    signals = constraint.expired_stock(scm.lot_state(snap, item))
    issue = constraint.signal_issues(signals).first()
    assert issue.detail == "expired_value_at_risk=100.0 exceeds threshold 0.0"
    assert constraint.root_causes(signals).first().root_cause == "Inventory aging beyond shelf life"
    assert constraint.action_plan(signals).first().responsible == "Planning"
    unknown = signals.replace("expired_value_at_risk", "something_new", "metric_name")
    assert constraint.root_causes(unknown).first().root_cause == "Unknown root cause"
    assert constraint.action_plan(unknown).first().priority == "MEDIUM"


def test_movement_needs_the_day_before(spark):
    snap = spark.createDataFrame(
        [(day(d), "WH-01", "SKU-001", "L", q, None, None, None)
         for d, q in (("2024-01-01", 100.0), ("2024-01-02", 90.0), ("2024-01-04", 90.0))],
        SNAPSHOT)
    ship = shipment(spark, ("S1", "2024-01-02", "SKU-001", 8.0, "O", "A"))
    back = spark.createDataFrame([], RETURN)
    mart = reco.inventory_movement(snap, receipt(spark), ship, back)
    assert rows(mart, "snapshot_date", "adjustments", "expected_onhand", "delta", "delta_ratio",
                "severity") == [(day("2024-01-02"), -2.0, 94.0, -4.0, -0.04, "warn")]


def test_receipts_of_a_bridge_system_count_on_both_sides(spark):
    got = receipt(spark, ("R1", "2024-01-02", "I", 5.0, "P", "erp_1"),
                  ("R2", "2024-01-03", "I", 3.0, "P", "WMS_1"),
                  ("R3", "2024-01-03", "I", 2.0, "P", "ERP_WMS"),
                  ("R4", "2024-01-03", "I", 9.0, None, "ERP"), ("R5", "2024-01-03", "I", 9.0, "P", "X"))
    assert rows(reco.erp_vs_wms_receipt(got), "erp_qty", "wms_qty", "delta") == [(7.0, 5.0, 2.0)]


def facts(spark, fx=(), settled=(), costs=(), charges=()):
    return coverage.domain_rows(
        spark.createDataFrame(list(fx), FX), spark.createDataFrame(list(settled), SETTLEMENT),
        spark.createDataFrame(list(costs), COST), spark.createDataFrame(list(charges), CHARGE))


def closed(spark, *periods):
    return spark.createDataFrame([(p,) for p in periods], "period string")


def test_coverage_grid(spark):
    rates = [("2024-01", "USD", 1300.0)]
    periods = coverage.known_periods(
        order(spark, ("O", 1, "2024-01-15", "A", "I", 1.0, None)), shipment(spark),
        spark.createDataFrame([], CHARGE), spark.createDataFrame([], SETTLEMENT))
    grid = coverage.coverage_period(periods, facts(spark, fx=rates), closed(spark))
    got = {r.domain: (r.coverage_rate, r.severity) for r in grid.collect()}
    assert len(got) == 6
    assert got["fx_rate"] == (1.0, "OK")
    assert got["revenue_settlement"] == (0.0, "INFO")
    shut = coverage.coverage_period(periods, facts(spark), closed(spark, "2024-01"))
    severe = {r.domain for r in shut.collect() if r.severity == "CRITICAL"}
    assert severe == {"fx_rate", "logistics_transport", "cost_structure"}


def test_coverage_without_any_period(spark):
    nothing = closed(spark)
    grid = coverage.coverage_period(nothing, facts(spark), nothing)
    assert {r.period for r in grid.collect()} == {"ALL"}


def test_closed_period_without_rates_is_an_error(spark):
    gaps = coverage.closed_period_gaps(closed(spark, "2024-01"), facts(spark))
    assert any("fx_rate" in r.message and "has 0 rows" in r.message for r in gaps.collect())


def test_unknown_warehouse_and_missing_cost(spark):
    lots = spark.createDataFrame(
        [("W1", "I", 5.0, 5.0, 0.0, 0.0), ("W2", "J", 7.0, 0.0, 7.0, 0.0)],
        "warehouse_id string, item_id string, onhand_qty double, sellable_qty double, "
        "blocked_qty double, expired_qty double")
    dim = spark.createDataFrame([("W1", "3PL", "US")],
                                "warehouse_id string, warehouse_type string, country string")
    assert rows(boards.inventory_by_warehouse_type(lots, dim), "warehouse_type", "country",
                "onhand_qty") == [("3PL", "US", 5.0), ("UNKNOWN", "KR", 7.0)]
    price = spark.createDataFrame([("I", "M", day("2024-01-01"), 2.0)], COST)
    assert rows(boards.inventory_value(lots, price), "total_value", "lots_with_cost",
                "lots_without_cost") == [(10.0, 1, 1)]


def test_delay_signals_read_one_table_of_sums(spark):
    lines = po(spark, ("P1", "S", "I", "2024-01-10"), ("P2", "S", "J", "2024-01-10"), ("P3", "T", "I", None))
    got = receipt(spark, ("R1", "2024-01-20", "I", 1.0, "P1", "WMS"), ("R2", "2024-03-15", "I", 1.0, "P1", "WMS"),
                  ("R3", "2024-03-18", "J", 1.0, "P2", "WMS"), ("R4", "2024-03-18", "I", 1.0, None, "WMS"))
    sums = constraint.delay_sums(lines, got)
    assert rows(sums, "supplier_id", "receipt_month", "gap", "arrivals") == [
        ("S", "2024-01", 10, 1), ("S", "2024-03", 133, 2)]
    columns = ["entity_id", "current_value", "period"]
    assert rows(constraint.supplier_delay(lines, got, sums=sums), *columns) == rows(
        constraint.supplier_delay(lines, got), *columns) == [("S", 47.7, "2024-01")]
    assert rows(constraint.dwell_time(lines, got, sums=sums), *columns) == rows(
        constraint.dwell_time(lines, got), *columns)


def test_effect_of_signals_reads_them_stored(spark, monkeypatch):
    names = constraint.SIGNAL_COLUMNS
    signals = spark.createDataFrame([
        ("S1", "supply", "late_po_ratio", 0.5, 0.2, "CRITICAL", "supplier", "1", "1997-01"),
        ("S2", "supply", "late_po_ratio", 0.25, 0.2, "HIGH", "supplier", "2", "1997-01"),
        ("S3", "finance", "expired_value_at_risk", 3.0, 0.0, "CRITICAL", "item", "7|1", "1998-06-01"),
    ], ", ".join(f"{n} {'double' if n.endswith('value') else 'string'}" for n in names))
    for query, want in {"c10_effectiveness": [("S1", 0.5, 0.0, -0.5, True)], "q19_resolved_share": [(1, 1)]}.items():
        kept = []
        mine = Marts(None, TODAY, keep=lambda df, name: kept.append(name) or df)
        mine.mart_constraint_signals = signals
        monkeypatch.setattr(registry, "marts", lambda *_: mine)
        shown = ["signal_id", "before_value", "after_value", "delta", "resolved"] if query[0] == "c" else ["resolved", "signals"]
        assert rows(registry.queries()[query](spark, "x"), *shown) == want
        assert kept == ["constraint-signals"]


def test_movement_groups_only_days_that_follow_a_snapshot(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-04", None]
    snap = spark.createDataFrame(
        [(d and day(d), "WH", i, None, 10.0, None, None, None) for d in days for i in ("I", "J")], SNAPSHOT)
    got = receipt(spark, ("R1", "2024-01-02", "I", 1.0, "P1", "WMS"), ("R2", "2024-01-04", "I", 1.0, "P1", "WMS"))
    mart = reco.inventory_movement(snap, got, shipment(spark), spark.createDataFrame([], RETURN))
    # An unknown day stays a group of its own.
    assert rows(mart, "snapshot_date", "item_id", "receipts", "adjustments") == [
        (None, "I", 0.0, 0.0), (None, "J", 0.0, 0.0),
        (day("2024-01-02"), "I", 1.0, -1.0), (day("2024-01-02"), "J", 0.0, 0.0)]
    assert "LeftSemi" in mart._jdf.queryExecution().optimizedPlan().toString()

import pytest

from conftest import FX, SETTLEMENT, cost, returns, rows, shipment
from tideledger.plans import pnl

PARTS = [("MATERIAL", 500.0), ("LABOR", 300.0), ("OVERHEAD", 200.0)]


def settlement(spark, *lines):
    return spark.createDataFrame(list(lines), SETTLEMENT)


def fx(spark, *lines):
    return spark.createDataFrame(list(lines), FX)


def test_components_add_up_to_one_unit_cost(spark):
    ship = shipment(spark, ("S1", "2024-01-15", "SKU-001", 10.0, "ORD-001", "STORE-A"))
    costs = cost(spark, *[("SKU-001", c, "2024-01-01", v) for c, v in PARTS])
    mart = pnl.cogs(ship, returns(spark), costs)
    assert rows(mart, "unit_cost_krw", "cogs_krw", "coverage_flag") == [
        (1000.0, 10000.0, "ACTUAL")]


def test_cost_version_follows_period(spark):
    ship = shipment(spark, ("S1", "2024-01-15", "SKU-001", 10.0, "O1", "STORE-A"),
                    ("S2", "2024-02-15", "SKU-001", 5.0, "O2", "STORE-A"))
    later = [("MATERIAL", 600.0), ("LABOR", 350.0), ("OVERHEAD", 250.0)]
    costs = cost(spark, *[("SKU-001", c, "2024-01-01", v) for c, v in PARTS],
                 *[("SKU-001", c, "2024-02-01", v) for c, v in later])
    assert rows(pnl.cogs(ship, returns(spark), costs), "period", "unit_cost_krw", "cogs_krw") == [
        ("2024-01", 1000.0, 10000.0), ("2024-02", 1200.0, 6000.0)]


def test_missing_cost_marks_the_whole_chain(spark):
    ship = shipment(spark, ("S1", "2024-01-15", "SKU-002", 10.0, "O1", "STORE-A"))
    cogs = pnl.cogs(ship, returns(spark), cost(spark))
    assert rows(cogs, "unit_cost_krw", "cogs_krw", "coverage_flag") == [(None, None, "PARTIAL")]
    rev = pnl.revenue(
        settlement(spark, ("2024-01", "SKU-002", "STORE-A", "KRW", 1e5, 0.0, 0.0, 1e5)), fx(spark))
    gm = pnl.gross_margin(rev, cogs)
    vc = pnl.variable_cost(spark.createDataFrame(
        [], "period string, item_id string, channel_store_id string, charge_domain string, "
            "charge_type string, allocated_amount_krw double"))
    contribution = pnl.contribution(gm, vc)
    profit = pnl.operating_profit(contribution)
    for mart in (gm, contribution, profit):
        assert rows(mart, "coverage_flag") == [("PARTIAL",)]


def test_stores_are_kept_apart_and_transfers_left_out(spark):
    ship = shipment(spark, ("S1", "2024-01-15", "SKU-001", 10.0, "O1", "STORE-A"),
                    ("S2", "2024-01-15", "SKU-001", 5.0, "O2", "STORE-B"),
                    ("S3", "2024-01-15", "SKU-001", 20.0, None, "STORE-B"))
    mart = pnl.cogs(ship, returns(spark), cost(spark))
    assert rows(mart, "channel_store_id", "qty_shipped") == [("STORE-A", 10.0), ("STORE-B", 5.0)]


def test_only_sales_returns_are_taken_off(spark):
    ship = shipment(spark, ("S1", "2024-01-15", "SKU-001", 10.0, "O1", "STORE-A"))
    back = returns(spark, ("R1", "2024-01-20", "SKU-001", 2.0, "O1"),
                   ("R2", "2024-01-20", "SKU-001", 5.0, None))
    assert rows(pnl.cogs(ship, back, cost(spark)), "qty_returned", "qty_net") == [(2.0, 8.0)]


def test_foreign_revenue_needs_a_rate(spark):
    lines = settlement(spark, ("2024-01", "SKU-001", "STORE-A", "USD", 100.0, 0.0, 0.0, 100.0))
    assert rows(pnl.revenue(lines, fx(spark)), "net_revenue_krw", "coverage_flag") == [
        (None, "PARTIAL")]
    rated = pnl.revenue(lines, fx(spark, ("2024-01", "USD", 1300.0)))
    assert rows(rated, "net_revenue_krw", "coverage_flag") == [(130000.0, "ACTUAL")]


def test_krw_is_actual_even_with_a_stray_rate(spark):
    lines = settlement(spark, ("2024-01", "S", "A", "KRW", 1e5, 5000.0, 1000.0, 94000.0))
    mart = pnl.revenue(lines, fx(spark, ("2024-01", "KRW", 2.0)))
    assert rows(mart, "net_revenue_krw", "coverage_flag") == [(94000.0, "ACTUAL")]


def test_country_comes_from_the_store_dimension_if_it_has_one(spark):
    lines = settlement(spark, ("2024-01", "S", "A", "KRW", 1.0, 0.0, 0.0, 1.0),
                       ("2024-01", "S", "B", "KRW", 1.0, 0.0, 0.0, 1.0))
    stores = spark.createDataFrame([("A", "JP")], "channel_store_id string, country string")
    assert rows(pnl.revenue(lines, fx(spark), stores), "channel_store_id", "country") == [
        ("A", "JP"), ("B", "KR")]


def test_gross_margin_keeps_both_sides_and_null_keys(spark):
    lines = settlement(spark, ("2024-01", "X", "A", "KRW", 10.0, 0.0, 0.0, 10.0),
                       ("2024-01", "X", "A", "KRW", 20.0, 0.0, 0.0, 20.0),
                       ("2024-01", None, "A", "KRW", 5.0, 0.0, 0.0, 5.0))
    ship = shipment(spark, ("S1", "2024-01-15", "X", 1.0, "O1", "A"),
                    ("S2", "2024-01-15", "Y", 1.0, "O1", "A"))
    costs = cost(spark, ("X", "M", "2024-01-01", 4.0), ("Y", "M", "2024-01-01", 3.0))
    gm = pnl.gross_margin(pnl.revenue(lines, fx(spark)), pnl.cogs(ship, returns(spark), costs))
    assert rows(gm, "item_id", "net_revenue_krw", "cogs_krw", "coverage_flag") == [
        ("X", 10.0, 4.0, "ACTUAL"), ("X", 20.0, 4.0, "ACTUAL"), ("Y", 0.0, 3.0, "PARTIAL"),
        (None, 5.0, 0.0, "PARTIAL")]


def test_duplicate_grain_stops_the_build(spark):
    twice = spark.createDataFrame([("p", "i", "s")] * 2, "period string, item_id string, "
                                  "channel_store_id string")
    with pytest.raises(ValueError, match="duplicate"):
        pnl.assert_unique_grain(twice, pnl.GRAIN, "mart")

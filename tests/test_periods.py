import tempfile

from conftest import day, returns, rows, shipment
from tideledger.plans import boards
from tideledger.plans.periods import OnePeriod, in_period, periods
from tideledger.sources.warehouse import Warehouse


class Source:
    """Stands in for the marts: two frames with periods, one without, and facts."""

    def __init__(self, spark):
        self.mart = spark.createDataFrame(
            [("2024-01", "A", 1.0), ("2024-02", "A", 2.0), ("2024-02", "B", 4.0), (None, "C", 8.0)],
            "period string, channel_store_id string, net_revenue_krw double")
        self.policy = spark.createDataFrame([("x",)], "charge_type string")
        self.closed = ["2024-01"]
        self.facts = self
        self.shipment = shipment(
            spark, ("S1", "2024-01-31", "I", 1.0, "O1", "A"), ("S2", "2024-02-01", "I", 2.0, "O2", "A"),
            ("S3", "2024-02-29", "I", 3.0, "O3", "A"), ("S4", "2024-03-01", "I", 4.0, "O4", "A"))
        self.returns = returns(spark, ("R1", "2024-02-10", "I", 1.0, "O1"))


def test_boards_see_one_period_of_marts_and_facts(spark):
    source = Source(spark)
    view = OnePeriod(source, "2024-02")
    assert rows(boards.revenue_by_store(view.mart), "channel_store_id", "net_revenue_krw") == [
        ("A", 2.0), ("B", 4.0)]
    assert rows(view.facts.shipment, "shipment_id") == [("S2",), ("S3",)]
    assert view.facts.returns.count() == 1 and OnePeriod(source, "2024-03").facts.returns.count() == 0
    assert view.policy.count() == 1 and view.closed == ["2024-01"]
    assert rows(source.shipment, "ship_date")[0] == (day("2024-01-31"),)
    assert OnePeriod(source, "1999-01").mart.count() == 0
    assert [r.period for r in periods(source.mart, source.mart.limit(0)).collect()] == ["2024-02", "2024-01"]
    assert periods(source.mart.limit(0)).count() == 0


def test_one_period_of_a_stored_mart_opens_no_other_folder(spark):
    source = Source(spark)
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="run-"), "periods_")
    for _ in range(2):
        wh.replace_by_period("mart", "mart_pnl_revenue", source.mart)
    stored = wh.read("mart", "mart_pnl_revenue")
    assert rows(stored, *source.mart.columns) == rows(source.mart, *source.mart.columns)
    chosen = in_period(stored, "2024-02")
    assert chosen.count() == 2
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "= 2024-02)]" in plan
    days = in_period(source.shipment, "2024-02", "ship_date")
    assert "date_format" not in days._jdf.queryExecution().optimizedPlan().toString()

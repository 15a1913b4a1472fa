from conftest import ITEM, SNAPSHOT, day, rows
from tideledger.plans import expiry, scm


def lots(spark, *lines, item=("SKU-001", "FG", 30, False)):
    snap = spark.createDataFrame(
        [(day(d), "WH-01", "SKU-001", lot, q, e and day(e), qc, hold)
         for d, lot, q, e, qc, hold in lines], SNAPSHOT)
    return snap, spark.createDataFrame([item], ITEM)


def state(spark, line, **kw):
    r = scm.lot_state(*lots(spark, line, **kw)).first()
    return r.expired_qty, r.blocked_qty, r.sellable_qty


def test_expired_sellable_and_held(spark):
    assert state(spark, ("2024-06-01", "A", 100.0, "2024-05-01", None, False)) == (100, 0, 0)
    assert state(spark, ("2024-01-01", "A", 100.0, "2024-12-31", None, False)) == (0, 0, 100)
    assert state(spark, ("2024-01-01", "A", 50.0, "2024-12-31", None, True)) == (0, 50, 0)


def test_short_shelf_life_and_qc_block(spark):
    assert state(spark, ("2024-01-01", "A", 5.0, "2024-01-30", None, None)) == (0, 5, 0)
    assert state(spark, ("2024-01-01", "A", 5.0, "2024-01-31", None, None)) == (0, 0, 5)
    qc = ("SKU-001", "FG", 30, True)
    assert state(spark, ("2024-01-01", "A", 5.0, None, "Released", False), item=qc) == (0, 0, 5)
    assert state(spark, ("2024-01-01", "A", 5.0, None, None, False), item=qc) == (0, 5, 0)


def test_default_days_follow_item_type(spark):
    for kind, days in (("RM", 30), ("PM", 90), ("FG", 60), ("WIP", 60), (None, 60)):
        snap, item = lots(spark, ("2024-01-01", "A", 1.0, None, None, None),
                          item=("SKU-001", kind, None, None))
        assert expiry.lot_expiry(snap, item).first().effective_min_sellable_days == days


def test_expired_issue_is_stable(spark):
    snap, item = lots(spark, ("2024-06-01", "A", 100.0, "2024-05-01", None, False),
                      ("2024-06-01", "B", 100.0, "2024-12-01", None, False))
    issues = expiry.expired_issues(scm.lot_state(snap, item))
    found = issues.collect()
    assert [(i.severity, i.issue_type, i.entity_id) for i in found] == [
        ("CRITICAL", "EXPIRED_STOCK", "SKU-001|A|WH-01")]
    assert expiry.new_issues(issues, issues).isEmpty()


def test_fefo_order_and_buckets(spark):
    snap, item = lots(spark, ("2024-01-01", "LOT-C", 1.0, "2024-09-01", None, None),
                      ("2024-01-01", "LOT-A", 1.0, "2024-03-01", None, None),
                      ("2024-01-01", "LOT-B", 1.0, "2024-06-01", None, None),
                      ("2024-01-01", "LOT-D", 1.0, None, None, None),
                      ("2024-01-01", "LOT-E", 1.0, "2023-12-31", None, None),
                      ("2024-01-01", "LOT-F", 1.0, "2025-06-01", None, None))
    mart = scm.inventory_onhand(snap, item)
    assert rows(mart, "lot_id", "fefo_rank", "expiry_bucket") == [
        ("LOT-A", 2, "60-90d"), ("LOT-B", 3, "90-180d"), ("LOT-C", 4, "180-365d"),
        ("LOT-D", None, "N/A"), ("LOT-E", 1, "EXPIRED"), ("LOT-F", 5, ">365d")]

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import CHARGE, FX, SHIPMENT, day, rows
from tideledger import config
from tideledger.plans import allocation


def ship(spark, lines):
    """Lines of (id, warehouse, item, qty, weight)."""
    return spark.createDataFrame(
        [(i, day("2024-01-05"), w, item, q, "L", kg, None, "O", None if q == 4 else "A")
         for i, w, item, q, kg in lines], SHIPMENT)


def charge(spark, *lines):
    """Lines of (invoice, type, amount, currency, warehouse)."""
    return spark.createDataFrame(
        [(i, 1, t, a, c, "2024-01", None, w) for i, t, a, c, w in lines], CHARGE)


def fx(spark, *lines):
    return spark.createDataFrame(list(lines), FX)


@pytest.mark.parametrize("amount,quantities", [
    (1000.0, [3.0, 5.0, 2.0]), (500.0, [1.0]), (999999.0, [float(n) for n in range(1, 8)]),
    (333.0, [1.0, 2.0]),
])
def test_allocation_adds_up(spark, amount, quantities):
    targets = ship(spark, [(f"S{n}", "W", "I", q, q) for n, q in enumerate(quantities)])
    kinds = ("LAST_MILE_PARCEL", "CUSTOMS_DUTY", "PLATFORM_FEE")
    out = allocation.allocate_charges(
        charge(spark, *[(f"INV-{k}", k, amount, "KRW", "W") for k in kinds]), fx(spark), targets)
    sums = out.groupBy("charge_type").agg(F.sum("allocated_amount").alias("s"), F.count("*").alias("n"))
    assert rows(sums, "charge_type", "s", "n") == sorted((k, amount, len(quantities)) for k in kinds)


def test_equals_window_form_with_ties_and_a_hot_warehouse(spark):
    rng = random.Random(3)
    lines = [(f"S{n:03d}", rng.choice(["HOT", "HOT", "B", "C"]), f"I{rng.randrange(6)}",
              float(rng.randrange(1, 6)), rng.choice([None, 1.5, 2.0, 7.0])) for n in range(240)]
    targets = ship(spark, lines)
    kinds = [row[0] for row in config.CHARGE_POLICY]
    charges = charge(spark, *[
        (f"INV{n}", kinds[n % len(kinds)], float(rng.randrange(50, 4000)) + (n % 2) / 2, "KRW",
         rng.choice(["HOT", "B", "C", "NOWHERE", None])) for n in range(40)])
    got = allocation.allocate_charges(charges, fx(spark), targets, slices=3)

    placed = allocation.scoped_charges(
        charges, fx(spark), allocation.scope_totals(allocation.allocation_targets(targets))
    ).where("allocation_basis IS NOT NULL").drop("warehouse_id", "channel_store_id")
    t = allocation.allocation_targets(targets)
    scoped = t.where("true").withColumn("w", F.col("warehouse_id"))
    pairs = placed.join(
        scoped, (F.col("scope") == F.col("w")) | (F.col("scope") == allocation.EVERYWHERE))
    order = Window.orderBy("warehouse_id", F.asc_nulls_first("channel_store_id"), "item_id",
                           "lot_id", "shipment_id")
    want = allocation.largest_remainder(
        pairs.withColumn("basis_value", allocation._by_basis(
            lambda b: F.coalesce(F.col(b), F.lit(0.0))))
        .withColumn("raw", allocation.share(F.col("basis_value"), 1))
        .withColumn("place", F.row_number().over(order)),
        allocation.CHARGE, "place", "raw", "amount")
    key = ["invoice_no", "item_id", "warehouse_id", "channel_store_id", "allocation_basis",
           "basis_value"]
    assert rows(got, *key, "allocated_amount") == [
        r for r in rows(want.withColumnRenamed("rounded", "allocated_amount"),
                        *key, "allocated_amount")]


def test_totals_equal_the_sums_of_the_rows(spark):
    rng = random.Random(5)
    lines = [(f"S{n}", rng.choice(["HOT", "HOT", "B", None]), f"I{n % 5}", float(rng.randrange(1, 5)),
              rng.choice([None, 0.1, 0.7, 2.3])) for n in range(90)]
    kinds = [row[0] for row in config.CHARGE_POLICY]
    charges = charge(spark, *[
        (f"INV{n}", kinds[n % len(kinds)], float(rng.randrange(0, 900)) + rng.choice([0, 0.5, 0.37]),
         rng.choice(["KRW", "USD"]), rng.choice(["HOT", "B", "NOWHERE", None])) for n in range(40)])
    rates = fx(spark, ("2024-01", "USD", 1300.0))
    for targets in (ship(spark, lines), ship(spark, [])):
        sums = allocation.allocate_charges(charges, rates, targets).groupBy(
            "period", *allocation.CHARGE, "charge_domain", "cost_stage", "currency"
        ).agg(F.count("*").alias("targets"), *[F.round(F.sum(c), 3).alias(c) for c in (
            "allocated_amount", "allocated_amount_krw")])
        totals = allocation.charge_totals(charges, rates, targets)
        totals = totals.withColumn("allocated_amount_krw", F.round("allocated_amount_krw", 3))
        assert rows(sums, *sums.columns) == rows(totals, *sums.columns)


def random_allocation(spark, seed, n_lines=200, n_charges=50):
    rng = random.Random(seed)
    lines = [(f"S{n:03d}", rng.choice(["HOT", "HOT", "B", "C", None]), f"I{rng.randrange(5)}",
              float(rng.randrange(1, 6)), rng.choice([None, 0.1, 0.7, 2.3])) for n in range(n_lines)]
    kinds = [row[0] for row in config.CHARGE_POLICY]
    charges = charge(spark, *[
        (f"INV{n}", rng.choice(kinds), float(rng.randrange(0, 900)) + rng.choice([0, 0.5, 0.37]),
         rng.choice(["KRW", "USD"]), rng.choice(["HOT", "B", "NOWHERE", None]))
        for n in range(n_charges)])
    return charges, fx(spark, ("2024-01", "USD", 1300.0)), ship(spark, lines)


@pytest.mark.parametrize("seed,n_lines,decimals,points", [
    (1, 200, 0, 100_000), (2, 200, 2, 2), (3, 7, 0, 1), (4, 0, 0, 5)])
def test_sums_from_factors_equal_sums_of_pairs(spark, monkeypatch, seed, n_lines, decimals, points):
    monkeypatch.setattr(allocation, "BUCKET", 16)
    monkeypatch.setattr(allocation, "CUT_POINTS", points)
    charges, rates, targets = random_allocation(spark, seed, n_lines)
    spread = allocation.spread_charges(charges, rates, targets, decimals)
    pairs = allocation.expanded(spread)
    for charge_keys, target_keys in (
        (["period", "charge_domain", "charge_type"], ["item_id", "channel_store_id"]),
        (["period", *allocation.CHARGE], []),
    ):
        by = [*charge_keys, *target_keys]
        want = pairs.groupBy(*by).agg(
            F.count("*").alias("targets"), F.round(F.sum("allocated_amount"), 4).alias("amount"),
            F.round(F.sum("allocated_amount_krw"), 3).alias("krw"))
        got = allocation.allocated_sums(spread, charge_keys, target_keys).groupBy(*by).agg(
            F.sum("targets").alias("targets"), F.round(F.sum("allocated_amount"), 4).alias("amount"),
            F.round(F.sum("allocated_amount_krw"), 3).alias("krw"))
        assert rows(got, *by, "targets", "amount", "krw") == rows(want, *by, "targets", "amount", "krw")


def test_sums_look_at_lines_for_ties_only(spark):
    """Targets are grouped before they meet a charge, so no column that tells lines apart is read."""
    charges, rates, targets = random_allocation(spark, 8)
    spread = allocation.spread_charges(charges, rates, targets)
    even = spread.charges.where(F.col("allocation_basis").isin(allocation.CONSTANT))
    sums = allocation.allocated_sums(
        allocation.Spread(even, spread.parts, spread.targets, 1), ["period", "charge_type"],
        ["item_id", "channel_store_id"])
    plan = sums._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("shipment_id" in line for line in plan if "Relation" not in line)
    assert sums.count() > 0


def test_lines_do_not_move_to_few_open_ties(spark):
    ties = spark.range(5).selectExpr(
        "concat('I', id) invoice_no", "1L invoice_line_no", "'FREIGHT_INTL_SEA' charge_type", "'A' scope",
        "'weight' allocation_basis", "double(id) basis_value", "50L cut_position")
    targets = spark.range(100).selectExpr(
        "'A' warehouse_id", "concat('P', id % 4) item_id", "double(id % 10) weight", "id + 1 position",
        "id + 1 overall_position")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = allocation._tie_entries(ties, targets, [("weight", False)], ["item_id"])
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert got.agg(F.sum("hi")).first()[0] == 25


def test_view_over_stored_factors_equals_the_rows(spark):
    for seed, n_lines in ((5, 150), (6, 0)):
        spread = allocation.spread_charges(*random_allocation(spark, seed, n_lines), 2)
        spread.charges.createOrReplaceTempView("factors")
        spread.targets.createOrReplaceTempView("factor_targets")
        view = spark.sql(allocation.expansion_sql("factors", "factor_targets", spread.factor))
        want = allocation.expanded(spread)
        assert view.columns == want.columns
        assert rows(view, *view.columns) == rows(want, *view.columns)


def test_scope_falls_back_to_all_shipments(spark):
    targets = ship(spark, [("S1", "A", "I", 1.0, 1.0), ("S2", "B", "I", 1.0, 1.0)])
    out = allocation.allocate_charges(
        charge(spark, ("I1", "PG_FEE", 10.0, "KRW", "A"), ("I2", "PG_FEE", 10.0, "KRW", None),
               ("I3", "PG_FEE", 10.0, "KRW", "Z")), fx(spark), targets)
    counts = rows(out.groupBy("invoice_no").count(), "invoice_no", "count")
    assert counts == [("I1", 1), ("I2", 2), ("I3", 2)]


def test_rate_and_missing_rate(spark):
    targets = ship(spark, [("S1", "A", "I", 1.0, 1.0)])
    out = allocation.allocate_charges(
        charge(spark, ("I1", "PG_FEE", 10.0, "USD", "A"), ("I2", "PG_FEE", 10.0, "EUR", "A")),
        fx(spark, ("2024-01", "USD", 1300.0)), targets)
    assert rows(out, "invoice_no", "allocated_amount_krw") == [("I1", 13000.0), ("I2", 10.0)]


def test_without_shipments_the_charge_stays_whole(spark):
    out = allocation.allocate_charges(
        charge(spark, ("I1", "CUSTOMS_DUTY", 10.0, "KRW", "A"), ("I2", "PG_FEE", 7.0, "KRW", None)),
        fx(spark), ship(spark, []))
    assert rows(out, "invoice_no", "item_id", "warehouse_id", "allocation_basis",
                "allocated_amount") == [
        ("I1", "UNALLOCATED", "A", "value", 10.0),
        ("I2", "UNALLOCATED", "UNKNOWN", "revenue", 7.0)]


def test_unmeasurable_basis_is_reported(spark):
    targets = ship(spark, [("S1", "A", "I", 1.0, 1.0)])
    storage = charge(spark, ("I1", "3PL_STORAGE_FEE", 10.0, "KRW", "A"))
    assert allocation.allocate_charges(storage, fx(spark), targets).isEmpty()
    left = allocation.unallocated_charges(storage, fx(spark), targets)
    assert rows(left, "invoice_no", "amount") == [("I1", 10.0)]


@pytest.mark.parametrize("raw,total", [
    ([333.33, 333.33, 333.34], 1000.0), ([100.1, 200.3, 199.6], 500.0), ([1000.0], 1000.0)])
def test_largest_remainder_sums(spark, raw, total):
    df = spark.createDataFrame([("g", n, a, total) for n, a in enumerate(raw)],
                               "g string, n int, raw double, total double")
    out = allocation.largest_remainder(df, ["g"], "n", "raw", "total")
    assert out.agg(F.sum("rounded")).first()[0] == total
    assert allocation.largest_remainder(df.limit(0), ["g"], "n", "raw", "total").isEmpty()


def test_basis_priority():
    assert config.basis_priority("3PL_STORAGE_FEE") == ["onhand_cbm_days", "onhand_qty_days"]
    assert config.basis_priority("PG_FEE") == ["revenue", "line_count"]
    with pytest.raises(KeyError):
        config.basis_priority("NO_SUCH_FEE")


def test_shipments_without_warehouse_are_targets(spark):
    shipped = spark.createDataFrame(
        [(f"S{i}", day("2024-01-05"), w, "I", 1.0, "L", None, None, f"O{i}", "A")
         for i, w in enumerate(["W1", None, None, "W2"])], SHIPMENT)
    numbered = allocation.numbered_targets(allocation.allocation_targets(shipped)).collect()
    assert sorted(r.overall_position for r in numbered) == [1, 2, 3, 4]


def test_unknown_charge_types_are_reported(spark):
    charges = spark.createDataFrame(
        [("I1", 1, "NO_SUCH_TYPE", 10.0, "KRW", "2024-01", None, None)], CHARGE)
    shipped = spark.createDataFrame(
        [("S1", day("2024-01-05"), "W1", "I", 1.0, "L", None, None, "O1", "A")], SHIPMENT)
    rates = spark.createDataFrame([], FX)
    assert allocation.unallocated_charges(charges, rates, shipped).count() == 1


@pytest.mark.parametrize("seed", [11, 12])
def test_sums_of_asked_keys_equal_the_sums_of_all(spark, seed):
    """Only charges of a period that was asked for meet a target; what they give is unchanged."""
    spread = allocation.spread_charges(*random_allocation(spark, seed))
    keys = ["period", "item_id", "channel_store_id"]
    everything = allocation.allocated_sums(spread, keys[:1], keys[1:]).withColumns(
        {k: F.coalesce(k, F.lit(allocation.ANY)) for k in keys[1:]}
    ).groupBy(*keys).agg(F.round(F.sum("allocated_amount_krw"), 3).alias("krw"))
    some = everything.where(F.pmod(F.hash(*keys), F.lit(3)) == 0).select(*keys)
    asked = some.union(some).union(spark.createDataFrame(
        [("1999-01", "I", None)], ", ".join(f"{k} string" for k in keys)))
    got = allocation.allocated_sums(spread, keys[:1], keys[1:], only=asked).groupBy(*keys).agg(
        F.round(F.sum("allocated_amount_krw"), 3).alias("krw"))
    want = rows(everything.join(some, keys, "left_semi"), *keys, "krw")
    assert rows(got, *keys, "krw") == want and 0 < len(want) < everything.count()


def test_sums_are_made_in_pieces_of_bounded_pairs(spark, monkeypatch):
    """Prices are few and go to the targets, whose number of pieces follows from the pairs."""
    spread = allocation.spread_charges(*random_allocation(spark, 13))
    keys = ["period", "item_id", "channel_store_id"]
    pairs = allocation.expanded(spread)
    want = rows(pairs.groupBy(*keys).agg(F.round(F.sum("allocated_amount_krw"), 3).alias("krw")), *keys, "krw")
    monkeypatch.setattr(allocation, "PIECE_PAIRS", 50)
    sums = allocation.allocated_sums(spread, keys[:1], keys[1:])
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert f", {pairs.count() // 50 + 1}), REPARTITION_BY_NUM" in plan
    assert "SortMergeJoin" not in plan
    assert rows(sums.withColumn("krw", F.round("allocated_amount_krw", 3)), *keys, "krw") == want

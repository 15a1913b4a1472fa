import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import cost, day, rows
from tideledger.operators.asof import asof_join, latest_version
from tideledger.operators.joins import left_join_sparse_key
from tideledger.operators.ranking import globally_numbered, ordered_position, weighted_cut
from tideledger.operators.reconcile import reconcile
from tideledger.operators.upsert import newest_per_key, upsert
from tideledger.plans.scm import unit_costs


@pytest.mark.parametrize("split_rows", [3, 50, 1_000_000])
def test_position_equals_row_number_on_a_hot_group(spark, split_rows):
    rng = random.Random(1)
    data = [
        ("hot" if n % 3 else f"g{n % 7}", f"s{rng.randrange(4)}", f"t{n:04d}", rng.randrange(5))
        for n in range(600)
    ]
    df = spark.createDataFrame(data, "g string, s string, t string, u int")
    got = ordered_position(df, ["g"], ["s"], ["u", "t"], "pos", split_rows)
    want = df.withColumn(
        "pos",
        F.row_number().over(Window.partitionBy("g").orderBy("s", "u", "t")).cast("bigint"),
    )
    assert rows(got, "g", "s", "t", "u", "pos") == rows(want, "g", "s", "t", "u", "pos")


def test_one_group_and_equal_rows_are_split_over_tasks(spark):
    data = [(None if n % 2 else "w", 1, "same") if n % 3 else ("w", n, f"t{n}") for n in range(900)]
    df = spark.createDataFrame(data, "g string, s int, t string")
    got = ordered_position(df, ["g"], ["s"], ["t"], "pos", 10)
    want = df.withColumn(
        "pos", F.row_number().over(Window.partitionBy("g").orderBy("s", "t")).cast("bigint"))
    assert rows(got, "g", "s", "t", "pos") == rows(want, "g", "s", "t", "pos")
    numbered = globally_numbered(df, ["g", "s", "t"], "at", 10)
    assert [r.at for r in numbered.orderBy("at").collect()] == list(range(900))
    ordered = [(r.g or "", r.s, r.t) for r in numbered.orderBy("at").collect()]
    assert ordered == sorted(ordered)
    assert globally_numbered(df.limit(0), ["g"], "at").count() == 0


def test_rows_of_hot_groups_do_not_meet_in_a_task_per_group(spark):
    df = spark.range(6000).select((F.col("id") % 3).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 20_000)  # far less than the rows
    try:
        got = ordered_position(df, ["g"], [], ["t"], "pos", 100)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert got.agg(F.max("pos")).first()[0] == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ends = plan[:plan.index("Scan parquet")]  # above the rows that were numbered
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in ends


def cut_by_running_sum(data, ks):
    want = []
    for g, k in ks.items():
        passed = 0
        for v in sorted({v for h, v, _ in data if h == g}):
            n = sum(m for h, w, m in data if h == g and w == v)
            if passed + n >= k:
                want.append((g, v, passed))
                break
            passed += n
    return sorted(want)


@pytest.mark.parametrize("points", [1, 7, 100_000])
@pytest.mark.parametrize("shape", ["skewed", "outlier", "near_equal", "one_value"])
def test_weighted_cut_equals_running_sum(spark, shape, points):
    rng = random.Random(2)
    make = {
        "skewed": lambda n: round(rng.random() ** 4, 2),
        "outlier": lambda n: 1e300 if n % 50 == 0 else -1e300 if n % 50 == 1 else rng.random(),
        "near_equal": lambda n: 0.5 + rng.randrange(40) * 2.0**-53,
        "one_value": lambda n: 0.25,
    }[shape]
    data = [(f"g{n % 3}", make(n), rng.randrange(1, 5)) for n in range(240)]
    ks = {f"g{i}": k for i, k in enumerate([1, 77, 150])}
    df = spark.createDataFrame(data, "g string, v double, n int")
    wanted = spark.createDataFrame(list(ks.items()), "g string, k bigint")
    got = rows(weighted_cut(df, ["g"], "v", "n", wanted, "k", "cut", "before", 16, points),
               "g", "cut", "before")
    assert got == cut_by_running_sum(data, ks)


def test_asof_takes_the_version_in_force(spark):
    costs = unit_costs(cost(spark, ("SKU-001", "M", "2024-01-01", 5000.0),
                            ("SKU-001", "M", "2024-02-01", 5500.0)))
    base = spark.createDataFrame(
        [("SKU-001", day(d)) for d in ("2023-12-31", "2024-01-01", "2024-01-15", "2024-02-15")],
        "item_id string, d date",
    )
    found = asof_join(base, costs, ["item_id"], "d", "effective_from", ["unit_cost_krw"])
    assert rows(found, "d", "unit_cost_krw") == [
        (day("2023-12-31"), None), (day("2024-01-01"), 5000.0), (day("2024-01-15"), 5000.0),
        (day("2024-02-15"), 5500.0),
    ]
    inner = asof_join(base, costs, ["item_id"], "d", "effective_from", ["unit_cost_krw"], "inner")
    assert inner.count() == 3
    last = latest_version(costs, ["item_id"], "effective_from", ["unit_cost_krw"])
    assert rows(last, "item_id", "unit_cost_krw") == [("SKU-001", 5500.0)]


def test_asof_reads_each_version_once_and_keeps_odd_rows(spark):
    rng = random.Random(5)
    start = dt.date(1997, 1, 1)
    versions = [("hot", start + dt.timedelta(n), None if n % 10 == 0 else float(n))
                for n in range(10_000)]
    versions += [("few", start, 1.0), ("few", None, 2.0), (None, start, 3.0)]
    costs = spark.createDataFrame(versions, "item_id string, effective_from date, unit double")
    asked = [(n, "hot" if n % 3 else "few", start + dt.timedelta(rng.randrange(-50, 10_050)))
             for n in range(2_000)]
    asked += [(2_000, None, start), (2_001, "hot", None), (2_002, "unknown", start),
              (2_003, "hot", start), (2_003, "hot", start)]
    base = spark.createDataFrame(asked, "id int, item_id string, d date")

    def in_force(item, at):
        if item == "few":
            return 1.0 if at >= start else None
        if item != "hot" or at is None or at < start:
            return None
        return versions[min((at - start).days, 9_999)][2]

    found = asof_join(base, costs, ["item_id"], "d", "effective_from", ["unit"])
    want = sorted(((n, item, at, in_force(item, at)) for n, item, at in asked), key=repr)
    assert rows(found, "id", "item_id", "d", "unit") == want
    inner = asof_join(base, costs, ["item_id"], "d", "effective_from", ["unit"], "inner")
    known = [w for w in want if w[1] in ("hot", "few") and w[2] is not None and w[2] >= start]
    assert rows(inner, "id", "item_id", "d", "unit") == known
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "<=" not in plan and ">=" not in plan  # equality joins only
    none = asof_join(base.limit(0), costs, ["item_id"], "d", "effective_from", ["unit"])
    assert none.count() == 0


def test_sparse_key_join_equals_plain_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], "k string, id int")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k string, v string")
    got = left_join_sparse_key(left, right, "k", "id", spread=4)
    assert rows(got, "k", "id", "v") == rows(left.join(right, "k", "left"), "k", "id", "v")


def test_reconcile_equals_full_join_of_sums(spark):
    left = spark.createDataFrame(
        [("p", "a", 1.0), ("p", "a", 2.0), ("p", None, 5.0), ("q", "b", None)],
        "p string, k string, x double")
    right = spark.createDataFrame(
        [("p", "a", 3.0), ("p", None, 7.0), ("r", "c", 4.0)], "p string, k string, y double")
    got = reconcile(left, right, ["p", "k"], ("l", F.col("x")), ("r", F.col("y")))
    want = left.groupBy("p", "k").agg(F.sum("x").alias("l")).join(
        right.groupBy("p", "k").agg(F.sum("y").alias("r")), ["p", "k"], "full")
    assert rows(got, "p", "k", "l", "r") == rows(want, "p", "k", "l", "r")


def test_upsert_is_idempotent_and_replaces(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, t string")
    source = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    once = upsert(target, source, ["k"])
    assert rows(once, "k", "v", "t") == [("a", 1, "old"), ("b", 3, None), ("c", 4, None)]
    assert rows(upsert(once, source, ["k"]), "k", "v", "t") == rows(once, "k", "v", "t")
    newest = newest_per_key(
        spark.createDataFrame([("a", "1.csv", 1), ("a", "2.csv", 2)], "k string, f string, v int"),
        ["k"], "f")
    assert rows(newest, "k", "v") == [("a", 2)]

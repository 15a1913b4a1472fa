"""Time the headline queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the data, the cores and the runs per query
(the median counts). ``facts`` is the time to derive and store the fact tables from the Parquet
tables. Every mart is then built anew from the facts for each run, so its own stored
intermediates are part of its time. Rows are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tideledger.plans import registry  # noqa: E402
from tideledger.session import tune  # noqa: E402

HEADLINE = [
    "m01_inventory_onhand", "m02_open_po", "m03_stockout_risk", "m04_overstock",
    "m05_expiry_risk", "m07_service_level", "m08_shipment_performance", "m09_shipment_daily",
    "m10_return_analysis", "m11_return_daily", "a1_charge_allocated", "p1_pnl_revenue",
    "p2_pnl_cogs", "p3_pnl_gross_margin", "p4_pnl_variable_cost", "p7_pnl_waterfall_summary",
    "r1_inventory_movement", "r2_oms_vs_wms", "r3_erp_vs_wms_receipt",
    "r4_settlement_vs_estimated", "c7_constraint_signals", "v2_coverage_period",
    "d06_quality_results", "s12_upsert", "q03_inventory_by_warehouse_type",
    "q14_turnover_kpis", "q22_revenue_kpis",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_ONLY", "").split(",")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    queries = registry.queries()

    def run(name: str) -> float:
        registry.forget()
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    start = time.perf_counter()
    facts = registry.stored_facts(spark, folder)
    for fact in (facts.lines, facts.inventory, facts.po):
        fact.count()
    built = {"facts": round(time.perf_counter() - start, 3)}
    run("p2_pnl_cogs")  # start the JVM's compiled code paths
    times = built | {
        name: round(statistics.median(run(name) for _ in range(runs)), 3)
        for name in HEADLINE
        if wanted == [""] or name in wanted
    }
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Profit-and-loss marts at the grain period, item, channel store, country.

A missing unit cost or exchange rate stays NULL and marks the row PARTIAL; nothing is filled
with zero or one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import month_key, or_zero, period_end
from tideledger.operators.asof import asof_join
from tideledger.plans.allocation import ANY
from tideledger.plans.scm import sales_only, unit_costs

GRAIN = ["period", "item_id", "channel_store_id"]


def revenue(
    settlement: DataFrame, exchange_rate: DataFrame, channel_store: DataFrame | None = None
) -> DataFrame:
    """One row per settlement line, converted to KRW."""
    lines = settlement
    country = F.lit("KR")
    if channel_store is not None and "country" in channel_store.columns:
        lines = lines.join(
            channel_store.select("channel_store_id", "country"), "channel_store_id", "left"
        )
        country = F.coalesce(F.col("country"), F.lit("KR"))
    rates = exchange_rate.select("period", "currency", "rate_to_krw")
    rate = F.when(F.col("currency") == "KRW", F.lit(1.0)).otherwise(F.col("rate_to_krw"))
    return lines.join(rates, ["period", "currency"], "left").select(
        *GRAIN,
        country.alias("country"),
        (or_zero("gross_sales") * rate).alias("gross_sales_krw"),
        (or_zero("discounts") * rate).alias("discounts_krw"),
        (or_zero("refunds") * rate).alias("refunds_krw"),
        (or_zero("net_payout") * rate).alias("net_revenue_krw"),
        F.lit("settlement").alias("source"),
        F.when(rate.isNotNull(), F.lit("ACTUAL")).otherwise(F.lit("PARTIAL")).alias(
            "coverage_flag"
        ),
    )


def cogs(shipment: DataFrame, returns: DataFrame, cost: DataFrame) -> DataFrame:
    """Cost of goods sold at the unit cost in force at the end of the period.

    Returns are known per period and item only, and are taken off every store's shipments.
    """
    shipped = (
        sales_only(shipment)
        .groupBy(
            month_key("ship_date").alias("period"),
            "item_id",
            F.coalesce("channel_store_id", F.lit("UNKNOWN")).alias("channel_store_id"),
        )
        .agg(F.sum("qty_shipped").alias("qty_shipped"))
    )
    returned = (
        sales_only(returns)
        .groupBy(month_key("return_date").alias("period"), "item_id")
        .agg(F.sum("qty_returned").alias("qty_returned"))
    )
    net = (
        shipped.join(returned, ["period", "item_id"], "left")
        .withColumn("qty_returned", or_zero("qty_returned"))
        .withColumn("qty_net", F.col("qty_shipped") - F.col("qty_returned"))
    )
    costed = asof_join(
        net, unit_costs(cost), ["item_id"], period_end("period"), "effective_from",
        ["unit_cost_krw"],
    )
    return costed.select(
        *GRAIN,
        F.lit("KR").alias("country"),
        "qty_shipped", "qty_returned", "qty_net", "unit_cost_krw",
        (F.col("qty_net") * F.col("unit_cost_krw")).alias("cogs_krw"),
        F.when(F.col("unit_cost_krw").isNotNull(), F.lit("ACTUAL"))
        .otherwise(F.lit("PARTIAL"))
        .alias("coverage_flag"),
    )


def duplicate_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: empty when the grain holds."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def assert_unique_grain(df: DataFrame, keys: list[str], name: str) -> None:
    """Stop the build when a key occurs twice."""
    if not duplicate_grain(df, keys).isEmpty():
        raise ValueError(f"{name} has duplicate rows for the grain {keys}")


def gross_margin(revenue_mart: DataFrame, cogs_mart: DataFrame) -> DataFrame:
    """Revenue lines full-joined with COGS.

    COGS is unique per grain while revenue is not, so this is written as a left join, which
    adaptive execution can split on a hot key, plus the COGS rows without any revenue.
    """
    cost_side = cogs_mart.select(
        *GRAIN,
        F.col("country").alias("cost_country"),
        "cogs_krw",
        F.col("coverage_flag").alias("cost_flag"),
    )
    sold = revenue_mart.select(
        *GRAIN, "country", "net_revenue_krw", F.col("coverage_flag").alias("revenue_flag")
    )
    matched = sold.join(cost_side, GRAIN, "left")
    unsold = cost_side.join(sold.select(*GRAIN).distinct(), GRAIN, "left_anti")
    both = matched.unionByName(unsold, allowMissingColumns=True)
    net, cost = or_zero("net_revenue_krw"), or_zero("cogs_krw")
    actual = (F.coalesce("revenue_flag", F.lit("PARTIAL")) == "ACTUAL") & (
        F.coalesce("cost_flag", F.lit("PARTIAL")) == "ACTUAL"
    )
    return both.select(
        *GRAIN,
        F.coalesce("country", "cost_country", F.lit("KR")).alias("country"),
        net.alias("net_revenue_krw"),
        cost.alias("cogs_krw"),
        (net - cost).alias("gross_margin_krw"),
        F.when(net != 0, (net - cost) / net).otherwise(F.lit(0.0)).alias("gross_margin_pct"),
        F.when(actual, F.lit("ACTUAL")).otherwise(F.lit("PARTIAL")).alias("coverage_flag"),
    )


def variable_cost(sums: DataFrame) -> DataFrame:
    """Allocated charges per grain, domain and type, from their sums."""
    return sums.select(
        "period",
        F.coalesce("item_id", F.lit(ANY)).alias("item_id"),
        F.coalesce("channel_store_id", F.lit(ANY)).alias("channel_store_id"),
        F.lit("KR").alias("country"),
        "charge_domain", "charge_type", "allocated_amount_krw",
        F.lit("ACTUAL").alias("coverage_flag"),
    )


def contribution(gross_margin_mart: DataFrame, variable_cost_mart: DataFrame) -> DataFrame:
    """Margin less variable cost; only ``GRAIN`` and amount are read of the cost."""
    totals = variable_cost_mart.groupBy(*GRAIN).agg(
        F.sum("allocated_amount_krw").alias("total_vc")
    )
    vc = or_zero("total_vc")
    left_over = F.col("gross_margin_krw") - vc
    return gross_margin_mart.join(totals, GRAIN, "left").select(
        *GRAIN,
        "country",
        "gross_margin_krw",
        vc.alias("total_variable_cost_krw"),
        left_over.alias("contribution_krw"),
        F.when(F.col("net_revenue_krw") != 0, left_over / F.col("net_revenue_krw"))
        .otherwise(F.lit(0.0))
        .alias("contribution_pct"),
        F.coalesce("coverage_flag", F.lit("PARTIAL")).alias("coverage_flag"),
    )


def operating_profit(contribution_mart: DataFrame) -> DataFrame:
    """Contribution less fixed cost, which is zero until it is entered by hand."""
    return contribution_mart.select(
        *GRAIN,
        "country",
        "contribution_krw",
        F.lit(0.0).alias("fixed_cost_krw"),
        F.col("contribution_krw").alias("operating_profit_krw"),
        F.col("contribution_pct").alias("operating_profit_pct"),
        F.coalesce("coverage_flag", F.lit("PARTIAL")).alias("coverage_flag"),
    )


def waterfall_summary(
    revenue_mart: DataFrame,
    cogs_mart: DataFrame,
    gross_margin_mart: DataFrame,
    variable_cost_mart: DataFrame,
    contribution_mart: DataFrame,
    operating_profit_mart: DataFrame,
) -> DataFrame:
    """Six amounts per period in waterfall order."""
    sources = [
        (revenue_mart, "net_revenue_krw"),
        (cogs_mart, "cogs_krw"),
        (gross_margin_mart, "gross_margin_krw"),
        (variable_cost_mart, "allocated_amount_krw"),
        (contribution_mart, "contribution_krw"),
        (operating_profit_mart, "operating_profit_krw"),
    ]
    steps = [
        df.groupBy("period")
        .agg(or_zero(F.sum(amount)).alias("amount_krw"))
        .select(
            "period",
            F.lit(name).alias("metric_name"),
            F.lit(n).cast("int").alias("metric_order"),
            "amount_krw",
        )
        for n, ((df, amount), name) in enumerate(zip(sources, config.WATERFALL_METRICS), 1)
    ]
    return reduce(DataFrame.unionByName, steps)

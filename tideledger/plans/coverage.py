"""Which data domains are present in which period, and what a closed period still lacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import month_key

EVERY_PERIOD = "ALL"
CHARGE_DOMAINS = {name: domain for name, domain, *_ in config.CHARGE_POLICY}


def domain_rows(
    exchange_rate: DataFrame, settlement: DataFrame, cost: DataFrame, charge: DataFrame
) -> DataFrame:
    """Row count per domain and period. Unit costs have no period and count under 'ALL'."""
    spark = charge.sparkSession
    one = F.count(F.lit(1)).alias("included_rows")

    def counted(df: DataFrame, domain: str) -> DataFrame:
        return df.groupBy("period").agg(one).select(F.lit(domain).alias("domain"), "*")

    # Eighteen fixed rows.
    policy = F.broadcast(
        spark.createDataFrame(list(CHARGE_DOMAINS.items()), "charge_type string, domain string")
    )
    return reduce(
        DataFrame.unionByName,
        [
            counted(exchange_rate, "fx_rate"),
            counted(settlement, "revenue_settlement"),
            counted(cost.select(F.lit(EVERY_PERIOD).alias("period")), "cost_structure"),
            charge.join(policy, "charge_type").groupBy("domain", "period").agg(one),
        ],
    )


def known_periods(
    order: DataFrame, shipment: DataFrame, charge: DataFrame, settlement: DataFrame
) -> DataFrame:
    """Every month that any fact mentions."""
    return reduce(
        DataFrame.union,
        [
            order.select(month_key("order_date").alias("period")).distinct(),
            shipment.select(month_key("ship_date").alias("period")).distinct(),
            charge.select("period").distinct(),
            settlement.select("period").distinct(),
        ],
    ).where(F.col("period") != "").distinct()


def coverage_period(periods: DataFrame, rows: DataFrame, closed: DataFrame) -> DataFrame:
    """Coverage of each policy domain in each known period ('ALL' when there is none).

    ``closed`` holds the closed periods in a column ``period``.
    """
    policy = [
        (d, config.is_domain_required(d, False), config.is_domain_required(d, True))
        for d in config.COVERAGE_DOMAINS
    ]
    listed = F.array(
        *[
            F.struct(
                F.lit(d).alias("domain"), F.lit(o).alias("if_open"), F.lit(c).alias("if_closed")
            )
            for d, o, c in policy
        ]
    )
    fallback = (
        periods.agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == 0)
        .select(F.lit(EVERY_PERIOD).alias("period"))
    )
    # Each period is repeated for the six domains of the policy.
    grid = (
        periods.unionByName(fallback)
        .join(closed.select("period", F.lit(True).alias("is_closed")), "period", "left")
        .withColumn("is_closed_period", F.coalesce("is_closed", F.lit(False)))
        .select("period", "is_closed_period", F.explode(listed).alias("d"))
        .select("period", "is_closed_period", "d.*")
    )
    n = F.coalesce("included_rows", F.lit(0)).cast("bigint")
    enough = n >= config.COVERAGE_MIN_ROWS
    required = F.when(F.col("is_closed_period"), F.col("if_closed")).otherwise(F.col("if_open"))
    return grid.join(rows, ["domain", "period"], "left").select(
        "period",
        "domain",
        F.when(enough, F.lit(1.0)).otherwise(F.lit(0.0)).alias("coverage_rate"),
        n.alias("included_rows"),
        F.when(enough, F.lit(0)).otherwise(config.COVERAGE_MIN_ROWS - n).cast("bigint").alias(
            "missing_rows"
        ),
        F.when(enough, F.lit("OK"))
        .when(required, F.lit("CRITICAL"))
        .otherwise(F.lit("INFO"))
        .alias("severity"),
        "is_closed_period",
    )


def closed_period_gaps(closed: DataFrame, rows: DataFrame) -> DataFrame:
    """One message per closed period and required domain without enough rows."""
    required = [d for d, need in config.COVERAGE_WHEN_CLOSED.items() if need == "REQUIRED"]
    grid = closed.select(
        "period", F.explode(F.array(*[F.lit(d) for d in required])).alias("domain")
    )
    n = F.coalesce("included_rows", F.lit(0)).cast("bigint")
    message = F.format_string(
        f"%s: closed period %s has %d rows and needs {config.COVERAGE_MIN_ROWS}",
        "domain", "period", n,
    )
    return (
        grid.join(rows, ["domain", "period"], "left")
        .where(n < config.COVERAGE_MIN_ROWS)
        .select("period", "domain", n.alias("included_rows"), message.alias("message"))
    )

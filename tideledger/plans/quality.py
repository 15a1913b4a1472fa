"""Data-quality checks on raw files: one result row per file and check.

All value checks of a table's files come from one aggregation over the rows, plus one by
business key for duplicates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger import config
from tideledger.functions.columns import count_where

# Words accepted as booleans.
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]
RESULT = "file_name string, check_name string, severity string, passed boolean, " \
         "bad_rows bigint, detail string"


def cast_value(c: Column, type_name: str) -> Column:
    """Lenient cast of text: what cannot be read becomes NULL."""
    if type_name == "string":
        return c
    if type_name == "date":
        return F.to_date(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    if type_name == "boolean":
        word = F.lower(c)
        return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(
            word.isin(FALSE_WORDS), F.lit(False)
        )
    return c.try_cast(type_name)


def required_columns(columns: list[str], table: str) -> list[str]:
    """Required columns a header lacks, without regard to case."""
    have = {c.lower() for c in columns}
    return [c for c in config.CONTRACTS[table].required if c.lower() not in have]


def _result(name: str, severity: str, bad: Column, failed: Column, fine: str) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(severity).alias("severity"),
        (bad == 0).alias("passed"),
        bad.cast("bigint").alias("bad_rows"),
        F.when(bad == 0, F.lit(fine)).otherwise(failed).alias("detail"),
    )


def check_files(rows: DataFrame, table: str, file: str = "file_name") -> DataFrame:
    """Results for all files in ``rows``: text columns under canonical names, plus the file."""
    contract = config.CONTRACTS[table]
    columns = [c for c in rows.columns if c != file]
    keys = [k for k in contract.key if k in columns]
    typed = {c: t for c, t in contract.columns.items() if c in columns}
    missing = required_columns(columns, table)

    counts = [count_where(F.col(k).isNull()).alias(f"null_{k}") for k in keys] + [
        count_where(F.col(c).isNotNull() & cast_value(F.col(c), t).isNull()).alias(f"bad_{c}")
        for c, t in typed.items()
        if t in ("bigint", "double")
    ]
    per_file = rows.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), *counts)

    results = [
        _result(
            "required_columns", "CRITICAL", F.lit(len(missing)),
            F.lit(f"{table} lacks the columns {missing}"),
            f"{table} has all columns it needs",
        )
    ]
    for k in keys:
        bad = F.col(f"null_{k}")
        results.append(
            _result(
                f"null_business_key_{k}", "CRITICAL", bad,
                F.format_string(f"{table}: %d rows without key column {k}", bad),
                f"{table}: key column {k} is filled",
            )
        )
    for c, t in typed.items():
        strict = t in ("bigint", "double")
        bad = F.col(f"bad_{c}") if strict else F.lit(0)
        results.append(
            _result(
                f"type_coercion_{c}", "HIGH", bad,
                F.format_string(f"{table}: %d rows whose {c} is no {t}", bad.cast("bigint")),
                f"{table}: {c} is {t} throughout",
            )
        )
    found = per_file.select(F.col(file).alias("file_name"), F.explode(F.array(*results)).alias("r"))
    parts = [found.select("file_name", "r.*")]
    if keys:
        parts.append(duplicate_keys(rows, table, keys, file))
    if table == "fact_charge_actual" and "charge_type" in columns:
        parts.append(unknown_charge_types(rows, file))
    return reduce(DataFrame.unionByName, parts)


def required_values(rows: DataFrame, table: str, file: str = "file_name") -> DataFrame:
    """Required columns other than keys, per file: rows without a value after the cast."""
    contract = config.CONTRACTS[table]
    columns = {c: t for c, t in contract.required.items()
               if c in rows.columns and c not in contract.key}
    counts = [count_where(cast_value(F.col(c), t).isNull()).alias(f"null_{c}")
              for c, t in columns.items()]
    per_file = rows.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), *counts)
    results = [
        _result(
            f"null_required_{c}", "HIGH", F.col(f"null_{c}"),
            F.format_string(f"Required column '{c}' has no value in %d rows of {table}", f"null_{c}"),
            f"Required column '{c}' has a value in every row",
        )
        for c in columns
    ]
    if not results:
        return rows.sparkSession.createDataFrame([], RESULT)
    found = per_file.select(F.col(file).alias("file_name"), F.explode(F.array(*results)).alias("r"))
    return found.select("file_name", "r.*")


def duplicate_keys(rows: DataFrame, table: str, keys: list[str], file: str) -> DataFrame:
    """Rows beyond the first of each business key, per file."""
    extra = (
        rows.groupBy(file, *keys)
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .groupBy(file)
        .agg(F.sum("extra").alias("extra"))
    )
    result = _result(
        "duplicate_business_keys", "HIGH", F.col("extra"),
        F.format_string(f"{table}: %d rows repeat a key {keys}", "extra"),
        f"{table}: keys are unique",
    )
    return extra.select(F.col(file).alias("file_name"), result.alias("r")).select(
        "file_name", "r.*"
    )


def unknown_charge_types(rows: DataFrame, file: str) -> DataFrame:
    """One failed result per file and charge type the policy does not know."""
    known = F.col("charge_type").isin([row[0] for row in config.CHARGE_POLICY])
    unknown = F.coalesce(~known, F.lit(True))
    per_type = (
        rows.groupBy(file, F.when(unknown, F.coalesce("charge_type", F.lit("None"))).alias("t"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bad", F.when(F.col("t").isNull(), F.lit(0)).otherwise(F.col("n")))
    )
    result = _result(
        "charge_type_validation", "HIGH", F.col("bad"),
        F.format_string("Unknown charge type not in policy: %s", "t"),
        "Charge types known to the policy",
    )
    return per_type.select(F.col(file).alias("file_name"), result.alias("r")).select(
        "file_name", "r.*"
    )


def failures(results: DataFrame) -> DataFrame:
    """Failed results that reject a file."""
    return results.where(~F.col("passed") & F.col("severity").isin("CRITICAL", "HIGH"))


def failed_files(results: DataFrame) -> DataFrame:
    """Rejected files with the first failure's text and how many checks failed."""
    return failures(results).groupBy("file_name").agg(
        F.min_by("detail", F.struct("severity", "check_name")).alias("error"),
        F.count(F.lit(1)).alias("failed_checks"),
    )

"""Inbox of CSV files: list, route, check and load into the fact tables.

Files are read as lines in splits of any number, so a file may be of any size, quoted line breaks
included. All files with one header are read, checked and loaded together in one plan, however
many there are; what is known of each file stays in a table. The driver sees distinct headers only.

``ingest`` loads a folder once. ``ingest_stream`` hands the same steps to a file stream, whose log
remembers which files were seen.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideledger import config
from tideledger.operators.joins import is_small
from tideledger.operators.staging import staged
from tideledger.operators.upsert import newest_per_key
from tideledger.plans import quality
from tideledger.sources.csv_splits import (
    file_name, file_summaries, parsed, split_summaries, text_lines,
)
from tideledger.sources.headers import canonical_names, detect_table

GLOB = "*.{csv,CSV}"
SAME_CONTENT = "Skipped: a load with the same content was successful"


def list_files(spark: SparkSession, inbox: str) -> DataFrame:
    """file (a number), file_name and size of every CSV file; contents are not read. Spark's file
    sources leave out files of no bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", GLOB).load(inbox)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.xxhash64(name).alias("file"), name.alias("file_name"), F.col("length").alias("size"))


def lines_of(spark: SparkSession, inbox: str) -> DataFrame:
    """The lines of every CSV file, in splits."""
    return text_lines(
        spark.read.format("text").option("lineSep", "\n").option("pathGlobFilter", GLOB).load(inbox)
    )


def identified(files: DataFrame, lines: DataFrame) -> DataFrame:
    """``files`` with file_hash, header and open_at.

    The hash is one of size, number of lines and their digest, and so one of the bytes.
    """
    about = file_summaries(split_summaries(lines))
    content = F.concat_ws(":", "size", F.coalesce("lines", F.lit(0)), F.coalesce("digest", F.lit("")))
    return files.join(about, "file", "left").select(
        "file", "file_name", F.sha2(content, 256).alias("file_hash"), "header", "open_at"
    )


def not_loaded(files: DataFrame, file_log: DataFrame) -> DataFrame:
    """Files whose content was not loaded successfully before."""
    loaded = file_log.where(F.col("status") == "success").select("file_hash").distinct()
    return files.join(loaded, "file_hash", "left_anti")


def routes(headers: list[str]) -> dict[str, tuple[str | None, list[str], str | None]]:
    """Header to table, canonical column names and error."""
    found = {}
    for header in headers:
        columns = next(csv.reader([header]), [])
        try:
            table = detect_table(columns)
            found[header] = (table, canonical_names(columns, table), None)
        except ValueError as e:
            found[header] = (None, columns, str(e))
    return found


def with_key_sentinel(rows: DataFrame, table: str) -> DataFrame:
    """Fill key columns that files may leave out (the lot) before keys are checked."""
    contract = config.CONTRACTS[table]
    for k in contract.key:
        if k in contract.optional:
            value = F.col(k) if k in rows.columns else F.lit(None).cast("string")
            rows = rows.withColumn(k, F.coalesce(value, F.lit(config.NO_LOT)))
    return rows


def cast_columns(rows: DataFrame, table: str) -> DataFrame:
    """Contract columns present in ``rows``, cast leniently to their types."""
    return rows.select(
        *[
            quality.cast_value(F.col(c), t).alias(c)
            for c, t in config.CONTRACTS[table].columns.items()
            if c in rows.columns
        ],
        *[c for c in ("file_name", "file_hash") if c in rows.columns],
    )


def with_system_columns(rows: DataFrame, batch_id: int) -> DataFrame:
    """Source system and key defaults, batch, file hash and load time."""
    have = set(rows.columns)
    source = F.col("source_system") if "source_system" in have else F.lit("unknown")
    return rows.withColumns(
        {
            "source_system": source,
            "source_pk": F.col("source_pk") if "source_pk" in have else F.lit(None).cast("string"),
            "load_batch_id": F.lit(batch_id).cast("bigint"),
            "source_file_hash": F.col("file_hash"),
            "loaded_at": F.current_timestamp(),
        }
    ).drop("file_hash")


def fact_schema(table: str) -> T.StructType:
    """Stored layout of a fact: contract columns, then system columns."""
    contract = config.CONTRACTS[table]
    columns = {**contract.columns, **config.SYSTEM_COLUMNS}
    required = set(contract.required)
    return T.StructType(
        [
            T.StructField(c, T.StructType.fromDDL(f"c {t}")["c"].dataType, c not in required)
            for c, t in columns.items()
        ]
    )


def ingest(warehouse, inbox: str, batch_id: int, dry_run: bool = False,
           reject_closed: bool = False) -> DataFrame:
    """Process every file of the inbox and return one row per file, as it was logged.

    Where two files of a run carry the same key, the later file name wins, as if they had been
    loaded one after the other in name order. A dry run checks everything and writes only the log,
    with a status of its own, so that the later real run still loads the files.
    """
    spark = warehouse.spark
    return load(
        warehouse, list_files(spark, inbox), lines_of(spark, inbox), batch_id, dry_run, reject_closed
    )


def ingest_stream(warehouse, inbox: str, checkpoint: str, next_batch, files_per_batch: int = 1000,
                  reject_closed: bool = False) -> None:
    """Load what is new in the inbox by a file stream, in batches of ``files_per_batch`` files, oldest
    first, and stop when nothing is left.

    The stream's log below ``checkpoint`` holds the files seen. A run that was killed repeats its last
    batch: files that were logged as loaded are skipped then, and the upsert of others replaces the
    rows it may have written before. ``next_batch`` gives a batch's id.
    """
    spark = warehouse.spark
    reader = spark.readStream.format("text").option("lineSep", "\n").option("pathGlobFilter", GLOB)
    files = reader.option("maxFilesPerTrigger", files_per_batch).load(inbox)
    lines = text_lines(files.select("value", "_metadata")).withColumns(
        {"file_name": file_name(), "size": F.col("_metadata.file_size")}
    )

    def one_batch(rows: DataFrame, _: int) -> None:
        # A stream has a session of its own, which must see what its earlier batches stored.
        here = warehouse.in_session(rows.sparkSession)
        listed = staged(rows.select("file", "file_name", "size").distinct(), "listed")
        load(here, listed, rows.select("file", "block", "value"), next_batch(), False, reject_closed)

    query = (
        lines.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        warehouse.refresh()


def load(warehouse, files: DataFrame, lines: DataFrame, batch_id: int, dry_run: bool,
         reject_closed: bool) -> DataFrame:
    """Decide on ``files``, load the rows of the good ones, and log all of them."""
    spark = warehouse.spark
    listed = staged(identified(files, lines), "listed-files")
    # Of equal new files the first by name counts.
    fresh = not_loaded(listed, warehouse.file_log())
    first = fresh.groupBy("file_hash").agg(F.min("file_name").alias("file_name"))
    fresh = staged(fresh.join(first, ["file_hash", "file_name"]), "fresh-files")
    # Distinct headers: a handful of layouts.
    headers = [r[0] for r in fresh.where(F.col("header").isNotNull()).select("header").distinct().collect()]
    by_header = routes(headers)
    known = {h: r for h, r in by_header.items() if r[0]}
    results = [
        fresh.where(F.col("header").isNull()).select(
            "file_name", F.lit(None).cast("string").alias("table_name"), F.lit(0).cast("bigint").alias("n"),
            F.lit("skipped").alias("status"), F.lit("Empty file").alias("error_msg"),
        )
    ]
    strange = [(h, r[2]) for h, r in by_header.items() if not r[0]]
    if strange:
        reasons = spark.createDataFrame(strange, "header string, error_msg string")
        results.append(fresh.join(F.broadcast(reasons), "header").select(
            "file_name", F.lit(None).cast("string"), F.lit(0).cast("bigint"), F.lit("error"), "error_msg"))

    loads: dict[str, list[DataFrame]] = {}
    if known:
        open_blocks = fresh.select("file", F.explode("open_at")).collect()
        width = max(len(r[1]) for r in known.values())
        cells = parsed(lines, [tuple(r) for r in open_blocks], width)
        for header, (table, columns, _) in known.items():
            members = fresh.where(F.col("header") == header).select("file", "file_name")
            side = F.broadcast(members) if is_small(members) else members
            raw = cells.join(side, "file").select(
                *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "file_name"
            )
            rows = with_key_sentinel(raw, table)
            outcome = staged(
                decided(warehouse, rows, members, table, batch_id, reject_closed), "file-outcomes"
            )
            results.append(outcome)
            good = outcome.where(F.col("status") == "success").join(fresh, "file_name").select(
                "file_name", "file_hash"
            )
            side = F.broadcast(good) if is_small(good) else good
            loads.setdefault(table, []).append(cast_columns(rows.join(side, "file_name"), table))

    results = staged(reduce(DataFrame.union, results), "new-files")
    if not dry_run:
        for table, parts in loads.items():
            source = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
            keys = list(config.CONTRACTS[table].key)
            newest = newest_per_key(source, keys, "file_name").drop("file_name")
            warehouse.upsert(table, with_system_columns(newest, batch_id))
    outcomes = staged(all_outcomes(listed, fresh, results, dry_run), "outcomes")
    if not outcomes.isEmpty():
        warehouse.append("raw", "system_file_log", outcomes.select(
            F.lit(batch_id).cast("bigint").alias("batch_id"), "*",
            F.current_timestamp().alias("processed_at"),
        ))
    return outcomes


def decided(warehouse, rows: DataFrame, members: DataFrame, table: str, batch_id: int,
            reject_closed: bool) -> DataFrame:
    """file_name, table_name, n, status and error_msg of the files of one layout, whose quality
    results are logged."""
    checks = quality.check_files(rows, table).unionByName(quality.required_values(rows, table))
    results = staged(checks, "quality-results")
    warehouse.append(
        "raw", "system_dq_report",
        results.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "file_name",
                       F.lit(table).alias("table_name"), "check_name", "severity", "passed",
                       "detail", F.current_timestamp().alias("checked_at")),
    )
    sizes = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    found = (
        members.select("file_name")
        .join(sizes, "file_name", "left")
        .join(quality.failed_files(results).select("file_name", "error"), "file_name", "left")
    )
    closed = F.lit(None).cast("boolean")
    if reject_closed:
        touching = closed_period_files(rows, table, warehouse)
        found = found.join(touching.withColumn("closed", F.lit(True)), "file_name", "left")
        closed = F.col("closed")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    status = (
        F.when(n == 0, F.lit("skipped"))
        .when(F.col("error").isNotNull(), F.lit("dq_failed"))
        .when(closed, F.lit("error"))
        .otherwise(F.lit("success"))
    )
    reason = (
        F.when(n == 0, F.lit("Empty file"))
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(closed, F.lit("File touches a closed period"))
    )
    return found.select(
        "file_name", F.lit(table).alias("table_name"), F.when(status == "success", n).otherwise(0).alias("n"),
        status.alias("status"), reason.alias("error_msg"),
    )


def all_outcomes(listed: DataFrame, fresh: DataFrame, results: DataFrame, dry_run: bool) -> DataFrame:
    """One row per listed file: the new ones as decided, copies of them like them, others skipped."""
    decided_for = fresh.select("file_hash", F.col("file_name").alias("first_name")).join(
        results.withColumnRenamed("file_name", "first_name"), "first_name"
    )
    own = F.col("file_name") == F.col("first_name")
    # A copy of a file that was loaded is one that is there already.
    skipped = F.col("first_name").isNull() | (~own & (F.col("status") == "success"))
    done = F.when(F.lit(dry_run) & (F.col("status") == "success"), F.lit("dry_run")).otherwise(F.col("status"))
    return listed.join(decided_for, "file_hash", "left").select(
        "file_name", "file_hash", "table_name",
        F.when(own, F.col("n")).otherwise(0).cast("bigint").alias("row_count"),
        F.when(skipped, F.lit("skipped")).otherwise(done).alias("status"),
        F.when(skipped, F.lit(SAME_CONTENT)).otherwise(F.col("error_msg")).alias("error_msg"),
    )


def closed_period_files(rows: DataFrame, table: str, warehouse) -> DataFrame:
    """Files with at least one row of a closed period: by its date, or by the period it names."""
    event = config.CONTRACTS[table].event
    months = [F.substring(F.col(c), 1, 7).cast("string")
              for c in dict.fromkeys([event, "period"]) if c in rows.columns]
    return (
        rows.select("file_name", F.explode(F.array(F.lit(None).cast("string"), *months)).alias("period"))
        .distinct()
        .join(warehouse.closed_periods(), "period", "left_semi")
        .select("file_name")
        .distinct()
    )

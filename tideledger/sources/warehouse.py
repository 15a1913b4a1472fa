"""Stored tables: four Spark databases of Parquet tables in the session catalog.

Facts are partitioned by event month. An upsert or a rollback rewrites only the months it
touches: the new content is staged first and then swapped in by a dynamic partition overwrite,
so no table is read and overwritten at the same time. Logs are append-only; the current state
of a batch or a period is its latest entry.
"""

from __future__ import annotations

import copy
import os
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideledger import config
from tideledger.functions.columns import month_key
from tideledger.operators.staging import staged
from tideledger.operators.upsert import align, upsert, without_batches
from tideledger.sources.inbox import fact_schema

LAYERS = ("raw", "core", "mart", "ops")
MONTH = "event_month"
# Bits of a month's key filter. A month of 8 million keys is read in vain for one key in nine.
KEY_BITS = 1 << 26

SCHEMAS = {
    "system_batch_log": "batch_id bigint, started_at timestamp, finished_at timestamp, "
                        "status string, file_count bigint, rows_ingested bigint, "
                        "error_msg string, logged_at timestamp",
    "system_file_log": "batch_id bigint, file_name string, file_hash string, "
                       "table_name string, row_count bigint, status string, "
                       "error_msg string, processed_at timestamp",
    "system_dq_report": "batch_id bigint, file_name string, table_name string, "
                        "check_name string, severity string, passed boolean, detail string, "
                        "checked_at timestamp",
    "ops_issue_log": "issue_id string, issue_type string, severity string, domain string, "
                     "entity_type string, entity_id string, period string, detail string, "
                     "created_at timestamp, resolved_at timestamp",
    "ops_period_close": "period string, closed_at timestamp, closed_by string, "
                        "lock_flag boolean, notes string, logged_at timestamp",
    "ops_adjustment_log": "adjustment_id bigint, period string, table_name string, "
                          "business_key string, field_name string, old_value string, "
                          "new_value string, reason string, adjusted_by string, "
                          "batch_id bigint, adjusted_at timestamp",
    "dim_item": "item_id string, item_type string, min_sellable_days int, "
                "qc_required_flag boolean, volume_cbm double",
    "dim_warehouse": "warehouse_id string, warehouse_type string, country string",
    "dim_channel_store": "channel_store_id string, channel string, store string",
}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, prefix: str = "scm_"):
        self.spark = spark
        self.prefix = prefix
        self.root = root.rstrip("/")
        for layer in LAYERS:
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} LOCATION '{root}/{layer}'"
            )

    def in_session(self, spark: SparkSession) -> Warehouse:
        """The same tables, read and written through another session of the application."""
        other = copy.copy(self)
        other.spark = spark
        return other

    def refresh(self) -> None:
        """Forget which files tables had, after another session wrote to them."""
        for layer in LAYERS:
            for t in self.spark.catalog.listTables(f"{self.prefix}{layer}"):
                if not t.isTemporary:
                    self.spark.catalog.refreshTable(f"{self.prefix}{layer}.{t.name}")

    def claim(self, kind: str, at_least: int) -> int:
        """The smallest number from ``at_least`` on that nobody has claimed for ``kind``. A claim is an
        empty file that is created only where it does not exist, so two runs never get one number."""
        folder = f"{self.root}/_claims/{kind}"
        number = at_least
        while not self._create_new(f"{folder}/{number}"):
            number += 1
        return number

    def _create_new(self, file: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(file)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(path.getParent())
        if files.getScheme() == "file":
            # Hadoop's local file system looks first and creates then; the system call does both at once.
            try:
                os.close(os.open(files.makeQualified(path).toUri().getPath(), os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
            return True
        try:
            files.create(path, False).close()
        except Py4JJavaError as e:
            if files.exists(path):
                return False
            raise e
        return True

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        """The table, or an empty frame of the given layout while it does not exist."""
        if self.exists(layer, table):
            return self.spark.table(self.name(layer, table))
        return self.spark.createDataFrame([], schema or SCHEMAS[table])

    def append(self, layer: str, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").format("parquet").saveAsTable(self.name(layer, table))

    def replace(self, layer: str, table: str, rows: DataFrame) -> None:
        """Full refresh of a mart or dimension."""
        rows.write.mode("overwrite").format("parquet").saveAsTable(self.name(layer, table))

    def replace_by_period(self, layer: str, table: str, rows: DataFrame) -> None:
        """Full refresh of a mart that boards read by period: a folder for each period, so that one
        period's board opens no other one's files. Rows of a period are brought together first, large
        periods in several files; an empty period text is stored as NULL."""
        rows.hint("rebalance", "period").write.mode("overwrite").format("parquet").partitionBy(
            "period").saveAsTable(self.name(layer, table))

    def replace_view(self, layer: str, view: str, query: str) -> None:
        """A mart that is computed where it is read; takes the place of a table of that name."""
        name = self.name(layer, view)
        if self.exists(layer, view) and self.spark.catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {name}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")

    # ---- facts ------------------------------------------------------------------------

    def fact(self, table: str) -> DataFrame:
        schema = fact_schema(table).add(MONTH, "string")
        return self.read("core", table, schema).drop(MONTH)

    def _with_month(self, rows: DataFrame, table: str) -> DataFrame:
        event = config.CONTRACTS[table].event
        typed = config.CONTRACTS[table].columns[event]
        month = F.col(event) if typed == "string" else month_key(event)
        return rows.withColumn(MONTH, F.coalesce(month, F.lit("none")))

    def upsert(self, table: str, source: DataFrame) -> None:
        """Replace rows with the source's business keys and add the rest."""
        empty = self.spark.createDataFrame([], fact_schema(table))
        rows = staged(self._with_month(align(source, empty), table), f"upsert-{table}")
        name = self.name("core", table)
        if not self.exists("core", table):
            rows.write.format("parquet").partitionBy(MONTH).saveAsTable(name)
            self._store_filter(table, rows)
            return
        keys = list(config.CONTRACTS[table].key)
        stored = self.spark.table(name)
        # Months whose filter knows none of the keys are not read at all.
        possible = stored.where(F.col(MONTH).isin(self.months_with_keys(table, rows)))
        matched = possible.join(rows.select(*keys), keys, "left_semi").select(MONTH)
        months = self._months(rows.select(MONTH).unionByName(matched))
        touched = stored.where(F.col(MONTH).isin(months))
        self._swap(table, upsert(touched, rows, keys), months)

    # ---- key filters: which months may hold a key -------------------------------------------

    def _filter_name(self, table: str) -> str:
        return self.name("core", f"{table}_keys")

    def _store_filter(self, table: str, rows: DataFrame) -> None:
        """Replace the key filters of the months in ``rows``: a bitmap of key hashes per month, kept in
        buckets of 32,768 bits that exist only where a bit is set."""
        at = key_bit(list(config.CONTRACTS[table].key))
        filters = rows.groupBy(F.bitmap_bucket_number(at).alias("bucket"), MONTH).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
        )
        name = self._filter_name(table)
        if not self.spark.catalog.tableExists(name):
            filters.select("bucket", "bits", MONTH).write.format("parquet").partitionBy(MONTH).saveAsTable(name)
            return
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        filters.select("bucket", "bits", MONTH).write.mode("overwrite").insertInto(name)
        self.spark.catalog.refreshTable(name)

    def months_with_keys(self, table: str, rows: DataFrame) -> list[str]:
        """Months that may hold a key of ``rows``: all that do, and seldom another. Stored rows are
        not read."""
        name = self._filter_name(table)
        if not self.spark.catalog.tableExists(name):
            # A table of earlier versions: its filters are made once.
            self._store_filter(table, self.spark.table(self.name("core", table)))
        at = key_bit(list(config.CONTRACTS[table].key))
        wanted = rows.select(
            F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")
        ).distinct()
        byte = F.conv(F.hex(F.substring("bits", F.expr("cast(bit div 8 as int) + 1"), F.lit(1))), 16, 10)
        is_set = byte.cast("int").bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
        return self._months(
            self.spark.table(name).join(wanted, "bucket").where(is_set).select(MONTH)
        )

    def remove_batches(self, table: str, batch_ids: list[int]) -> None:
        if not self.exists("core", table):
            return
        stored = self.spark.table(self.name("core", table))
        months = self._months(stored.where(F.col("load_batch_id").isin(batch_ids)).select(MONTH))
        if months:
            touched = stored.where(F.col(MONTH).isin(months))
            self._swap(table, without_batches(touched, batch_ids), months)

    @staticmethod
    def _months(rows: DataFrame) -> list[str]:
        """Distinct months: a calendar-sized list, not data."""
        return sorted(r[0] for r in rows.distinct().collect())

    def _swap(self, table: str, content: DataFrame, months: list[str]) -> None:
        name = self.name("core", table)
        ready = staged(content, f"swap-{table}")
        kept = self._months(ready.select(MONTH))
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        ready.select(*self.spark.table(name).columns).write.mode("overwrite").insertInto(name)
        self._store_filter(table, ready)
        for month in set(months) - set(kept):
            for t in (name, self._filter_name(table)):
                self.spark.sql(f"ALTER TABLE {t} DROP IF EXISTS PARTITION ({MONTH}='{month}')")
        self.spark.catalog.refreshTable(name)

    # ---- the facts by the names the marts use ------------------------------------------

    order = property(lambda self: self.fact("fact_order"))
    shipment = property(lambda self: self.fact("fact_shipment"))
    returns = property(lambda self: self.fact("fact_return"))
    inventory = property(lambda self: self.fact("fact_inventory_snapshot"))
    po = property(lambda self: self.fact("fact_po"))
    receipt = property(lambda self: self.fact("fact_receipt"))
    settlement = property(lambda self: self.fact("fact_settlement"))
    charge = property(lambda self: self.fact("fact_charge_actual"))
    exchange_rate = property(lambda self: self.fact("fact_exchange_rate"))
    cost = property(lambda self: self.fact("fact_cost_structure"))
    item = property(lambda self: self.read("core", "dim_item"))
    warehouse = property(lambda self: self.read("core", "dim_warehouse"))
    channel_store = property(lambda self: self.read("core", "dim_channel_store"))

    # ---- logs ---------------------------------------------------------------------------

    def file_log(self) -> DataFrame:
        """Latest entry per batch and file."""
        log = self.read("raw", "system_file_log")
        return _latest(log, ["batch_id", "file_name"], "processed_at")

    def batch_log(self) -> DataFrame:
        return _latest(self.read("raw", "system_batch_log"), ["batch_id"], "logged_at")

    def issue_log(self) -> DataFrame:
        return self.read("ops", "ops_issue_log")

    def period_state(self) -> DataFrame:
        return _latest(self.read("ops", "ops_period_close"), ["period"], "logged_at")

    def closed_periods(self) -> DataFrame:
        return self.period_state().where(F.col("lock_flag")).select("period")

    def add_entry(self, layer: str, table: str, values: dict) -> None:
        """Append one log entry; columns left out are NULL, ``*_at`` ones given as True are now."""
        schema = T.StructType.fromDDL(SCHEMAS[table])
        plain = {k: v for k, v in values.items() if v is not True or not k.endswith("_at")}
        row = self.spark.createDataFrame([tuple(plain.get(f.name) for f in schema)], schema)
        for k in set(values) - set(plain):
            row = row.withColumn(k, F.current_timestamp())
        self.append(layer, table, row)

    def row_counts(self) -> DataFrame:
        """Rows of every stored table."""
        counts = [
            self.spark.table(f"{self.prefix}{layer}.{t.name}")
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(f"{layer}.{t.name}").alias("table_name"), "row_count")
            for layer in LAYERS
            for t in self.spark.catalog.listTables(f"{self.prefix}{layer}")
            if not t.isTemporary and not t.name.endswith("_keys")
        ]
        if not counts:
            return self.spark.createDataFrame([], "table_name string, row_count bigint")
        return reduce(DataFrame.unionByName, counts)


def key_bit(keys: list[str]):
    """The bit of a key in the filter of a month."""
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BITS))


def _latest(log: DataFrame, keys: list[str], at: str) -> DataFrame:
    whole = F.struct(*log.columns)
    return log.groupBy(*keys).agg(F.max_by(whole, F.col(at)).alias("r")).select("r.*")

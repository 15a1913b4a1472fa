"""Token totals kept up to date by signed changes.

A ledger is three tables in one folder, all append-only and one folder per batch: the changes of
each document, the totals they add per source, language and tokenizer version, and a mark that the
batch is complete. Readers see complete batches only, so a batch that died half-way is not there,
and writing it again overwrites its own folder. A batch that is complete is never applied twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ("source", "lang", "tokenizer_version")
CHANGE = ("batch_id string, doc_id long, source string, lang string, tokenizer_version string, "
          "docs long, tokens long")
TOTAL = "batch_id string, source string, lang string, tokenizer_version string, docs long, tokens long"
MARK = "batch_id string"


class TokenLedger:
    """Totals of tokens in ``folder``, which all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, table: str, batch_id: str = "*") -> str:
        return f"{self.folder}/{table}/{batch_id}"

    def _exists(self, pattern: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return found is not None and len(found) > 0

    def _read(self, table: str, schema: str) -> DataFrame:
        """Rows of complete batches. A mark counts once its write has ended."""
        marked = self._path("marks") + "/_SUCCESS"
        if not self._exists(marked):
            return self.spark.createDataFrame([], schema)
        marks = self.spark.read.schema(MARK).parquet(self._path("marks")).distinct()
        return self.spark.read.schema(schema).parquet(self._path(table)).join(marks, "batch_id", "left_semi")

    def committed(self, batch_id: str) -> bool:
        return self._exists(self._path("marks", batch_id) + "/_SUCCESS")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply ``changes(op, doc_id, source, lang, tokenizer_version, tokens)`` once.

        ``insert`` adds a document's count; ``revise`` replaces the count the ledger has of a
        document and version, if it has one; ``delete`` takes away all it has of a document,
        whatever version the row names. Of several rows for one document and version in a batch
        a delete wins over a revision and that over an insert, then the largest count; they are one
        change. An insert of a document and version the ledger has is a revision. A null count is
        0; null sources, languages and versions are groups of their own; rows without doc_id or
        with another op are ignored. An empty batch is committed and changes nothing. Returns False
        if the batch had been committed before; then nothing is written.
        """
        if self.committed(batch_id):
            return False
        rank = F.when(F.col("op") == "delete", 2).when(F.col("op") == "revise", 1).otherwise(0)
        rows = changes.where(F.col("doc_id").isNotNull() & F.col("op").isin("insert", "revise", "delete"))
        new = (
            rows.select(
                F.col("doc_id").cast("long").alias("doc_id"), F.col("tokenizer_version"),
                F.struct(rank.alias("rank"), F.coalesce(F.col("tokens"), F.lit(0)).cast("long").alias("tokens"),
                         "source", "lang").alias("row"),
            )
            .groupBy("doc_id", "tokenizer_version")
            .agg(F.max("row").alias("row"))
        )
        new = new.select("doc_id", "tokenizer_version", "row.*")
        plus = new.where(F.col("rank") < 2).select(
            "doc_id", "source", "lang", "tokenizer_version", F.lit(1).cast("long").alias("docs"), "tokens"
        )
        deleted = new.where(F.col("rank") == 2).select("doc_id").distinct()
        signed = plus.join(deleted, "doc_id", "left_anti")
        held = self.documents()
        if held is not None:
            # Old counts go out for every version a document is deleted from or counted anew in.
            gone = held.join(deleted, "doc_id", "left_semi")
            counted = signed.select("doc_id", F.col("tokenizer_version").alias("v"))
            anew = held.join(
                counted,
                (held["doc_id"] == counted["doc_id"]) & held["tokenizer_version"].eqNullSafe(counted["v"]),
                "left_semi",
            )
            out = gone.union(anew.join(deleted, "doc_id", "left_anti"))
            signed = signed.unionByName(out.select(
                "doc_id", "source", "lang", "tokenizer_version",
                (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"),
            ))
        changes_at = self._path("changes", batch_id)
        signed.withColumn("batch_id", F.lit(batch_id)).select(
            "batch_id", "doc_id", *GROUP, "docs", "tokens"
        ).write.mode("overwrite").parquet(changes_at)
        (
            self.spark.read.schema(CHANGE).parquet(changes_at)
            .groupBy(*GROUP)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .withColumn("batch_id", F.lit(batch_id))
            .select("batch_id", *GROUP, "docs", "tokens")
            .write.mode("overwrite").parquet(self._path("totals", batch_id))
        )
        self.spark.createDataFrame([(batch_id,)], MARK).write.mode("overwrite").parquet(
            self._path("marks", batch_id)
        )
        return True

    def documents(self) -> DataFrame | None:
        """What the ledger holds of each document and version; None before the first batch."""
        if not self._exists(self._path("marks") + "/_SUCCESS"):
            return None
        return (
            self._read("changes", CHANGE)
            .groupBy("doc_id", *GROUP)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where(F.col("docs") != 0)
        )

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, docs, tokens: sums of the batches' totals."""
        return (
            self._read("totals", TOTAL)
            .groupBy(*GROUP)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where(F.col("docs") != 0)
        )

"""Documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideledger.llm import toxicity
from tideledger.llm.lines import drop_boilerplate
from tideledger.llm.minhash import near_duplicates
from tideledger.llm.packing import packed
from tideledger.llm.secrets import redacted
from tideledger.operators.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below their language's threshold. Null and empty texts are scored
    like any other; repeated rows go or stay together."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "__score" + "_" * max(map(len, docs.columns), default=0)
    scored = toxicity.with_score(docs, "text", model, score)
    return scored.where(F.col(score) < toxicity.threshold_of("lang", model)).select(*docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the lines that their source repeats. Copies and near copies count once:
    the next stage is to find one of them with its text. Null texts stay null."""
    return with_text(docs, drop_boilerplate(docs, copies_once=True), F.col("clean_text"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, none before null.

    Shingles of five words, similarity 0.8. Rows are compared and dropped by themselves, so repeated
    and null ids neither keep copies nor lose other texts. Documents without words are kept.
    """
    row = "__row" + "_" * max(map(len, docs.columns), default=0)
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    groups = near_duplicates(rows, id_col=row, width=5, percent=80, coordinates=128, rows=4).select(
        F.col("doc_id").alias("of_row"), "component_id"
    )
    ids = rows.select(F.col(row).alias("of_row"), F.col("doc_id").alias("own_id"))
    first = groups.join(ids, "of_row").groupBy("component_id").agg(
        F.min(F.struct(F.col("own_id").isNull(), "own_id", "of_row")).alias("first")
    )
    kept = first.select(F.col("first.of_row").alias(row)).hint("merge")
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark. Null and empty texts stay as they are."""
    return with_text(docs, redacted(docs), F.col("text"))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes. Null and empty texts get one piece without a bin."""
    return packed(docs)


def with_text(docs: DataFrame, changed: DataFrame, text) -> DataFrame:
    """``docs``'s columns with another text and its length."""
    return changed.select(
        *(text.alias(c) if c == "text"
          else F.length(text).cast("long").alias(c) if c == "n_chars" else F.col(c)
          for c in docs.columns)
    )


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_boilerplate),
    ("near-dedup", without_near_copies),
    ("secrets", without_secrets),
    ("packing", into_sequences),
]

# A trained classifier is no SQL. tests/llm compares near-dedup and packing's words with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

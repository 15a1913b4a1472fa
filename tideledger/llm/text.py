"""Words, shingles and hashes of whole texts, as numpy arrays inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideledger.session import tune

# Rows of a batch that goes to Python: with texts of a few kilobytes some megabytes at a time.
BATCH_ROWS = 1000
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)
S30, S27, S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that all operators here count on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def texts_of(docs: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """The columns an operator needs and no more, so that extra columns cannot clash."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *(F.col(c).cast("string").alias(c) for c in others),
    )


def byte_texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, without decoding it."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def nth(i: int) -> np.uint64:
    """The i-th of a sequence of 64-bit seeds."""
    return np.uint64(i * int(STEP) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> S30)) * MIX_1
    x = (x ^ (x >> S27)) * MIX_2
    return x ^ (x >> S31)


def words_of(text: bytes) -> list[bytes]:
    """Runs of anything but the six ASCII white spaces, A-Z lower-cased."""
    return text.lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` words; the whole sequence as one if it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    acc = hashes[: n - width + 1].copy()
    for j in range(1, width):
        acc = acc * STEP + hashes[j : n - width + 1 + j]
    return mix(acc + nth(width))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive runs of ``values`` as an Arrow list column."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def each_batch(work):
    """Turn a function of one record batch into one of an iterator of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return run

"""Reproducible shuffles: a Feistel permutation over global row numbers.

Rows are numbered in an order of their own values, so the numbers do not depend on files, partitions
or executors. A keyed permutation of 0 .. n - 1 then gives each row its place in the shuffle, place p
being slot p // shards of shard p % shards. Both directions are arithmetic: the shard and slot of a
row follow from its number, and the number of the row that stands in a slot from the slot, without
any table of the shuffle.

The permutation works on a grid of a x b numbers with a * b >= n. Each round adds a keyed hash of
one coordinate to the other one; what leaves 0 .. n - 1 is permuted again until it is back (cycle
walking), which few numbers need, since the grid has less than a numbers too many.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger.llm.text import each_batch, mix, nth, prepared
from tideledger.operators.ranking import globally_numbered
from tideledger.session import scratch_path

SHARDS = 8
ROUNDS = 8
SEED = 20_240_601
# Rows of a file that write_shards makes.
FILE_ROWS = 100_000


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of 0 .. n - 1."""

    n: int
    seed: int = SEED
    rounds: int = ROUNDS

    @property
    def grid(self) -> tuple[int, int]:
        a = max(1, isqrt(self.n))
        return a, -(-self.n // a)

    def _add(self, i: int, coordinate: np.ndarray, size: int) -> np.ndarray:
        key = mix(np.array([self.seed], np.uint64) + nth(i + 1))
        return (mix(coordinate.astype(np.uint64) ^ key) % np.uint64(size)).astype(np.int64)

    def _once(self, x: np.ndarray) -> np.ndarray:
        a, b = self.grid
        left, right = x // b, x % b
        for i in range(0, 2 * self.rounds, 2):
            left = (left + self._add(i, right, a)) % a
            right = (right + self._add(i + 1, left, b)) % b
        return left * b + right

    def _once_back(self, x: np.ndarray) -> np.ndarray:
        a, b = self.grid
        left, right = x // b, x % b
        for i in range(2 * self.rounds - 2, -1, -2):
            right = (right - self._add(i + 1, left, b)) % b
            left = (left - self._add(i, right, a)) % a
        return left * b + right

    def _walk(self, step, x: np.ndarray) -> np.ndarray:
        out = step(np.asarray(x, np.int64))
        beyond = np.flatnonzero(out >= self.n)
        while len(beyond):
            out[beyond] = step(out[beyond])
            beyond = beyond[out[beyond] >= self.n]
        return out

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """The place of each row number in the shuffle."""
        return self._walk(self._once, numbers)

    def numbers(self, places: np.ndarray) -> np.ndarray:
        """The row number at each place of the shuffle."""
        return self._walk(self._once_back, places)


def shard_and_slot(numbers: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED):
    """Where the rows of these numbers go, of ``n`` rows in all."""
    places = Permutation(n, seed).places(numbers)
    return places % shards, places // shards


def number_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED):
    """The numbers of the rows that stand in these slots."""
    return Permutation(n, seed).numbers(np.asarray(slot) * shards + np.asarray(shard))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, none for null, and one) and text_crc32 of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )


def dealt(
    rows: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """``rows`` with row_number, shard and slot; ``rows`` must not have columns of these names.

    Rows are numbered from 0 in the order of the ``order`` columns, NULL first. Rows that agree on
    all of them take their numbers in any order, so ``order`` should tell apart what differs.
    Counts of shards are at most one apart and slots run from 0 without gaps. An empty table stays
    empty; with fewer rows than shards some shards are empty.
    """
    prepared(rows.sparkSession)
    numbered = globally_numbered(rows, order, "row_number")
    n = numbered.count()
    names = numbered.columns

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        numbers = batch.column("row_number").to_numpy(zero_copy_only=False)
        shard, slot = shard_and_slot(numbers, n, shards, seed)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(shard.astype(np.int32)), pa.array(slot)],
            [*names, "shard", "slot"],
        )

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in numbered.schema)}, shard int, slot long"
    return numbered.mapInArrow(each_batch(place), schema)


def sharded(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard and slot of each document.

    Documents are numbered by doc_id (null first), then size and checksum of the text; only these
    three leave the scan, so texts are read once and never shuffled. Null texts count as empty,
    repeated rows are rows of their own, other columns do not matter.
    """
    return dealt(digests(docs, id_col, text_col), ["doc_id", "size", "text_crc32"], shards, seed)


def write_shards(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    shards: int = SHARDS,
    seed: int = SEED,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """Write all columns of ``docs`` below ``path``, a folder ``shard=N`` for each shard, in files
    of at most ``file_rows`` consecutive slots, each in slot order; returns the stored table.

    Columns named shard, slot or row_number are kept with a trailing underscore.
    """
    taken = {"shard", "slot", "row_number"}
    plain = docs.select(*[F.col(f"`{c}`").alias(f"{c}_" if c in taken else c) for c in docs.columns])
    keys = plain.select("*", F.xxhash64(*[_hashable(plain, c) for c in plain.columns]).alias("__key"))
    placed = dealt(keys, [id_col, "__key"], shards, seed).drop("__key")
    spark = docs.sparkSession
    files = max(1, -(-placed.count() // file_rows))
    block = F.floor(F.col("slot") / file_rows)
    (
        placed.repartition(files, "shard", block)
        .sortWithinPartitions("shard", "slot")
        .write.option("maxRecordsPerFile", file_rows)
        .partitionBy("shard")
        .parquet(path)
    )
    return spark.read.parquet(path)


def _hashable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.struct(f"`{name}`")) if "map<" in kind or kind == "variant" else F.col(f"`{name}`")


def shard_folder(docs: DataFrame) -> str:
    """A fresh folder for shards in the shared place of the cluster."""
    return scratch_path(docs.sparkSession, "shards")

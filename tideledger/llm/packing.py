"""Pack documents into training sequences: best fit under conflicts.

Documents are dealt at random to shards of a bounded number of rows, and each shard is packed by
itself, so shards share no bin and a lost task is packed again to the same result. Within a shard
the pieces are placed from the longest to the shortest. Bins are ordered by what is left in them
and carry two bitmaps: the sources and the duplicate clusters they hold. The bin for a piece is
found by a successor search from the piece's length upward, until the tightest bin that holds
neither its source nor its cluster is found; else a new bin is opened.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger.llm.text import prepared

CAPACITY = 2048
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()),
                    ("size", pa.int64()), ("bin_id", pa.string()), ("bin_size", pa.int64())])
SHARD_ROWS = 8192


def word_count(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


class Bins:
    """Bins by residual capacity, with counts of all bins and of those that hold each source."""

    def __init__(self, capacity: int, n_sources: int):
        self.total = np.zeros(capacity + 1, np.int32)
        self.holding = np.zeros((n_sources, capacity + 1), np.int32)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.residual: list[int] = []

    def _count(self, bin_no: int, by: int) -> None:
        level, held = self.residual[bin_no], self.sources[bin_no]
        self.total[level] += by
        while held:
            bit = held & -held
            self.holding[bit.bit_length() - 1, level] += by
            held ^= bit

    def successor(self, need: int, source: int, cluster: int) -> int | None:
        """The tightest bin with room for ``need``, without the source and the cluster."""
        for level in need + np.flatnonzero(self.total[need:] > self.holding[source, need:]):
            for bin_no in self.at[level]:
                if not (self.sources[bin_no] >> source & 1 or self.clusters[bin_no] >> cluster & 1):
                    return bin_no
        return None

    def open(self, capacity: int) -> int:
        bin_no = len(self.residual)
        self.sources.append(0)
        self.clusters.append(0)
        self.residual.append(capacity)
        self.at[capacity].append(bin_no)
        self._count(bin_no, 1)
        return bin_no

    def put(self, bin_no: int, need: int, source: int, cluster: int) -> None:
        self._count(bin_no, -1)
        self.at[self.residual[bin_no]].remove(bin_no)
        self.sources[bin_no] |= 1 << source
        self.clusters[bin_no] |= 1 << cluster
        self.residual[bin_no] -= need
        self.at[self.residual[bin_no]].append(bin_no)
        self._count(bin_no, 1)


def best_fit(needs, sources, clusters, capacity: int) -> list[int]:
    """Bin of each piece, pieces placed in the given order."""
    bins = Bins(capacity, int(max(sources, default=-1)) + 1)
    out = []
    for need, source, cluster in zip(needs, sources, clusters):
        bin_no = bins.successor(need, source, cluster)
        if bin_no is None:
            bin_no = bins.open(capacity)
        bins.put(bin_no, need, source, cluster)
        out.append(bin_no)
    return out


def numbered(values: Iterable[str]) -> list[int]:
    """A small number for each distinct value, in order of first appearance."""
    numbers: dict[str, int] = {}
    return [numbers.setdefault(v, len(numbers)) for v in values]


def packed(
    docs: DataFrame,
    id_col: str = "doc_id",
    size: Column | None = None,
    source: str = "source",
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, size, bin_id, bin_size.

    ``size`` is a document's length (default: words of the column text), ``cluster`` names its
    duplicates (default: equal texts). A document longer than ``capacity`` is cut: full pieces fill
    bins of their own and the rest is packed like a short document. ``start`` is a piece's place in
    its document. A bin holds one document of each source and of each cluster at most. Null sources
    (and null clusters) count as one source (one cluster). Null and empty texts have size 0: they
    get one piece with no bin. Each row is a document, also with a repeated or null id. Ties are
    placed by id, then text. An empty table gives an empty result.
    """
    prepared(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")) if "text" in docs.columns else F.lit("")
    size = word_count(F.col("text")) if size is None else size
    cluster = F.md5(text) if cluster is None else cluster
    items = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("length"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(cluster.cast("string"), F.lit("")).alias("cluster"),
    )
    n_shards = -(-docs.count() // shard_rows) or 1
    # Rows alike in all columns are dealt out by their place, or they would share a shard.
    place = F.monotonically_increasing_id()
    sharded = items.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "cluster", "length", place), F.lit(n_shards))
    )
    full = F.col("length").cast("long")

    def work(shard: pa.Table) -> pa.Table:
        rows = shard.to_pylist()
        short = sorted(
            (r for r in rows if r["rest"]),
            key=lambda r: (-r["rest"], r["doc_id"] is not None, r["doc_id"] or 0, r["cluster"],
                           r["source"]),
        )
        bins = best_fit([r["rest"] for r in short], numbered(r["source"] for r in short),
                        numbered(r["cluster"] for r in short), capacity)
        used: dict[int, int] = defaultdict(int)
        for r, b in zip(short, bins):
            used[b] += r["rest"]
        name = rows[0]["shard"]
        out = [(r["doc_id"], r["whole"], r["whole"] * capacity, r["rest"], f"{name}-{b}", used[b])
               for r, b in zip(short, bins)]
        out += [(r["doc_id"], 0, 0, 0, None, None) for r in rows if not r["rest"] + r["whole"]]
        whole = [(r["doc_id"], piece) for r in rows for piece in range(r["whole"])]
        out += [(i, piece, piece * capacity, capacity, f"{name}-whole-{k}", capacity)
                for k, (i, piece) in enumerate(whole)]
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*out), PIECES)], schema=PIECES)

    return (
        sharded.select(
            "shard", "doc_id", "source", "cluster",
            F.floor(full / capacity).cast("long").alias("whole"),
            (full % capacity).alias("rest"),
        )
        .groupBy("shard")
        .applyInArrow(
            work,
            "doc_id long, piece long, start long, size long, bin_id string, bin_size long",
        )
    )

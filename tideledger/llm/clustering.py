"""Exact k-means on integer vectors with dictionaries of subvectors.

The vectors are stored once in pages of some thousand rows, without a shuffle. In a page every block
of dimensions is dictionary-encoded without loss: its distinct subvectors, and a code for each row.
A block is as wide as its dictionary stays small against the page and is halved otherwise, down
to single dimensions, so repeated vectors, quantised ones and plain ones all find their width.

A round computes the exact squared distance of each dictionary entry to each centroid once per
page; a row's distance is the sum of its codes' partial distances. Sums for the next centroids
follow from how often each cluster uses each code. Pages are independent: a round broadcasts the
centroids alone and brings back one row per centroid and dimension, whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.llm.text import prepared
from tideledger.operators.staging import staged

CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
PAGE_ROWS = 8192
WIDEST = 8
# Beyond this a squared distance of some hundred dimensions could leave 64 bits.
LARGEST = 1 << 27
PAGE = ("ids array<long>, widths array<int>, sizes array<int>, entries array<long>, codes binary")
BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"
# A page takes some megabytes, so few go to Python at a time.
PAGES_AT_ONCE = 8


def integer_vectors(
    vectors: DataFrame, id_col: str, vector: str, dim: int, scale: int
) -> DataFrame:
    """vec_id and the integers floor(scale * x) of the vectors that take part, as doubles."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    fine = (F.size(v) == dim) & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"), fine.alias("fine")
    ).where("fine").drop("fine")


def encode(rows: np.ndarray, widest: int = WIDEST) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
    """Widths, dictionaries and codes of the blocks of a page, in the order of the dimensions.

    A block wider than one dimension must have at most an eighth as many entries as there are rows.
    """
    n, dim = rows.shape
    widths, entries, codes = [], [], []
    todo = [(at, min(widest, dim - at)) for at in range(0, dim, widest)][::-1]
    while todo:
        at, width = todo.pop()
        block = np.ascontiguousarray(rows[:, at : at + width])
        if width > 1:
            whole = block.view([("", block.dtype)] * width).ravel()
            _, first, code = np.unique(whole.view(f"V{8 * width}"), return_index=True, return_inverse=True)
            if 8 * len(first) > n:
                half = width // 2
                todo += [(at + half, width - half), (at, half)]
                continue
            entry = block[first]
        else:
            entry, code = np.unique(block, return_inverse=True)
            entry = entry.reshape(-1, 1)
        widths.append(width)
        entries.append(entry)
        codes.append(code.ravel().astype(np.uint32))
    return widths, entries, codes


def pages(rows: DataFrame, dim: int, page_rows: int = PAGE_ROWS) -> DataFrame:
    """The vectors as encoded pages, one row each."""

    def page(ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
        whole = np.concatenate(parts)
        if len(whole) and np.abs(whole).max() >= LARGEST:
            raise ValueError(f"a scaled component reaches {LARGEST}: distances would leave 64 bits")
        widths, entries, codes = encode(whole.astype(np.int64))
        flat = np.concatenate([e.ravel() for e in entries])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
                pa.array([widths], pa.list_(pa.int32())),
                pa.array([[len(e) for e in entries]], pa.list_(pa.int32())),
                pa.array([flat], pa.list_(pa.int64())),
                pa.array([np.stack(codes).tobytes()], pa.binary()),
            ],
            ["ids", "widths", "sizes", "entries", "codes"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids.append(batch.column("vec_id"))
            parts.append(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            held += batch.num_rows
            if held >= page_rows:
                yield page(ids, parts)
                ids, parts, held = [], [], 0
        if held:
            yield page(ids, parts)

    return rows.mapInArrow(work, PAGE)


class Page:
    """One encoded page."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.ids = batch.column("ids")[i].values
        self.n = len(self.ids)
        widths, sizes = (batch.column(c)[i].values.to_numpy() for c in ("widths", "sizes"))
        flat = batch.column("entries")[i].values.to_numpy()
        codes = np.frombuffer(batch.column("codes")[i].as_py(), np.uint32).reshape(len(widths), self.n)
        ends = np.cumsum(widths * sizes)
        starts = np.cumsum(widths) - widths
        #: First dimension, distinct subvectors and codes of each block.
        self.blocks = [
            (int(at), flat[end - w * s : end].reshape(s, w), code)
            for at, end, w, s, code in zip(starts, ends, widths, sizes, codes)
        ]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row (ties: the smaller number) and its squared distance."""
        total = np.zeros((self.n, len(centroids)), np.int64)
        for at, entries, codes in self.blocks:
            gap = entries[:, None, :] - centroids[None, :, at : at + entries.shape[1]]
            total += (gap * gap).sum(axis=2)[codes]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(self.n), cluster]

    def sums(self, cluster: np.ndarray, k: int, dim: int) -> np.ndarray:
        """The sum of each cluster's rows."""
        out = np.zeros((k, dim), np.int64)
        for at, entries, codes in self.blocks:
            used = np.bincount(cluster * len(entries) + codes, minlength=k * len(entries))
            out[:, at : at + entries.shape[1]] += used.reshape(k, -1) @ entries
        return out


def each_page(batches: Iterator[pa.RecordBatch]) -> Iterator[Page]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Page(batch, i)


def next_centroids(stored: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of the mean of each centroid's vectors; a centroid without any stays."""
    k, dim = centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for page in each_page(batches):
            cluster, _ = page.nearest(centroids)
            counts += np.bincount(cluster, minlength=k)
            sums += page.sums(cluster, k, dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), dim)), pa.array(np.tile(np.arange(dim), k)),
             pa.array(np.repeat(counts, dim)), pa.array(sums.ravel())],
            ["cluster", "place", "n", "total"],
        )

    parts = stored.mapInArrow(work, "cluster long, place long, n long, total long")
    # Sums of many partitions may pass 64 bits. One row per centroid and dimension is collected.
    sums = parts.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    out = centroids.copy()
    for row in sums.where(F.col("n") > 0).collect():
        out[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return out


def first_centroids(rows: DataFrame, dim: int, k: int, prefix: str) -> np.ndarray:
    """The vectors whose ids hash smallest; of rows with one id, the smallest vectors."""
    key = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    first = rows.where(F.col("vec_id").isNotNull()).select(key.alias("key"), "vector")
    return np.array(
        [r["vector"] for r in first.orderBy("key", "vector").limit(k).collect()], np.float64
    ).astype(np.int64).reshape(-1, dim)


def clustered(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    dim: int = 64,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    prefix: str = "3:",
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance of each vector after ``rounds`` rounds, and the centroids.

    Vectors of exactly ``dim`` components take part, if none is null or not finite; components
    become floor(scale * x). Centroids start as the vectors with the smallest SHA-256 of ``prefix``
    and id. Repeated ids are rows of their own; a row without id is clustered but starts no
    centroid. Without any vector to start from the result is empty. A scaled component of 2**27 or
    more raises ValueError, since its distances may not fit 64 bits.
    """
    spark = prepared(vectors.sparkSession)
    rows = integer_vectors(vectors, id_col, vector, dim, scale).withColumn(
        "vector", F.transform("vector", lambda x: F.floor(x).cast("double"))
    )
    before = spark.conf.get(BATCHES)
    centroids = first_centroids(rows, dim, k, prefix)
    stored = staged(pages(rows, dim), "pages")
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], schema), centroids
    try:
        spark.conf.set(BATCHES, PAGES_AT_ONCE)
        for _ in range(rounds):
            moved = next_centroids(stored, centroids)
            if (moved == centroids).all():
                break
            centroids = moved
        final = centroids

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for page in each_page(batches):
                cluster, distance = page.nearest(final)
                yield pa.RecordBatch.from_arrays(
                    [page.ids, pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

        return staged(stored.mapInArrow(assign, schema), "assigned"), centroids
    finally:
        spark.conf.set(BATCHES, before)


def cluster_report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and the hash of each row's final centroid."""
    spark = assigned.sparkSession
    hashes = [
        (i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
        for i, c in enumerate(centroids)
    ]
    names = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    # One row per centroid.
    about = sums.join(F.broadcast(names), "cluster").join(F.broadcast(whole))
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

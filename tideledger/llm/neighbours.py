"""Nearest vectors by inner product from a forest of random-projection trees.

The trees are grown on the driver from a bounded sample; every vector is then sent to one leaf of
each tree. A query walks all trees through one priority queue, the least doubtful branch first,
until it has opened a set number of leaves: as many as hold a set share of the true neighbours of
some queries, which are found by comparing these with every vector. The vectors of those leaves are its candidates, and
their inner products are computed exactly, leaf by leaf, where leaves and queries meet. What a query finds
in a few leaves of one tree is a limit that candidates of all other leaves must reach.

For inner products of vectors of different length each vector gets one more coordinate, which
lifts all to the length of the longest; queries get 0 there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger.llm.text import prepared
from tideledger.operators.staging import staged

# Vectors the trees are grown from: those with the smallest hashes of their ids.
SAMPLE = 50_000
TREES = 16
LEAF_ROWS = 200
# Share of the true neighbours of some queries that the opened leaves must hold; as many leaves are
# opened for every query as these take.
RECALL = 0.96
MEASURED_ON = 48
NEAREST = 20
# Leaves of one tree that a query opens first, and entries of the leaves that meet queries in one task.
FIRST_LEAVES = 16
CELL_ROWS = 16_384


@dataclass
class Tree:
    """Inner nodes: a direction, a limit and two children; a child below zero is leaf -1 - child."""

    directions: np.ndarray
    limits: np.ndarray
    children: np.ndarray

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64)
        while (at >= 0).any() and len(self.limits):
            inner = at >= 0
            node = at[inner]
            side = (vectors[inner] * self.directions[node]).sum(axis=1) > self.limits[node]
            at[inner] = self.children[node, side.astype(int)]
        return -1 - at if len(self.limits) else at


def grow(sample: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    """Split by the direction between two random vectors, at the median, down to ``leaf_rows``."""
    directions, limits, children = [], [], []
    n_leaves = 0
    todo = [(np.arange(len(sample)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        a, b = (sample[rng.integers(len(rows), size=2)] if len(rows) <= leaf_rows
                else sample[rng.choice(rows, 2, replace=False)])
        length = np.linalg.norm(a - b)
        direction = (a - b) / length if length else a - b
        along = sample[rows] @ direction
        limit = float(np.median(along)) if len(rows) else 0.0
        right = along > limit
        if len(rows) <= leaf_rows or not right.any():
            if parent >= 0:
                children[parent][side] = -1 - n_leaves
            n_leaves += 1
            continue
        here = len(limits)
        directions.append(direction)
        limits.append(limit)
        children.append([0, 0])
        if parent >= 0:
            children[parent][side] = here
        todo += [(rows[~right], here, 0), (rows[right], here, 1)]
    dim = sample.shape[1]
    return Tree(np.array(directions).reshape(-1, dim), np.array(limits),
                np.array(children, np.int64).reshape(-1, 2))


def in_order(trees: list[Tree], query: np.ndarray) -> Iterator[tuple[int, int]]:
    """All leaves, from one queue over all trees: those first whose branches the query misses by the
    least sum of squared distances."""
    queue = [(0.0, t, 0) for t in range(len(trees))]
    while queue:
        beyond, t, node = heapq.heappop(queue)
        tree = trees[t]
        while node >= 0 and len(tree.limits):
            margin = float(tree.directions[node] @ query - tree.limits[node])
            near, far = tree.children[node, ::-1] if margin > 0 else tree.children[node]
            heapq.heappush(queue, (beyond + margin * margin, t, int(far)))
            node = int(near)
        yield t, -1 - node if len(tree.limits) else 0


def search(trees: list[Tree], query: np.ndarray, leaves: int) -> list[tuple[int, int]]:
    """The leaves to open."""
    return list(islice(in_order(trees, query), leaves))


def opened_until(trees: list[Tree], query: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many leaves are opened until each wanted vector, given by its leaf in every tree, is met."""
    met = np.zeros(len(wanted), np.int64)
    for n, (t, leaf) in enumerate(in_order(trees, query), 1):
        met[(met == 0) & (wanted[:, t] == leaf)] = n
        if (met > 0).all():
            break
    return met


def leaves_for(recall: float, asked: DataFrame, entries: DataFrame, sent, k: int, dim: int,
               longest: float, n: int = MEASURED_ON) -> int:
    """How many leaves hold a share ``recall`` of the true ``k`` nearest of ``n`` queries: those with
    the smallest hashes. They are compared with all vectors; a partition returns its best alone."""
    chosen = asked.orderBy(F.xxhash64("vector"), "query_id").limit(n).collect()
    if not chosen:
        return 1
    points = np.array([r["vector"] for r in chosen], np.float64)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, vectors = np.empty((len(points), 0)), np.empty((0, dim))
        for batch in batches:
            own = matrix(batch.column("vector"), dim)
            scores, vectors = np.hstack([scores, points @ own.T]), np.vstack([vectors, own])
            if vectors.shape[1] and scores.shape[1] > k + 1:
                kept = np.unique(np.argpartition(-scores, k, axis=1)[:, : k + 1])
                scores, vectors = scores[:, kept], vectors[kept]
        most = min(k + 1, scores.shape[1])
        if not most:
            return
        top = np.argpartition(-scores, most - 1, axis=1)[:, :most]
        where = np.stack([t.leaves(lifted(vectors, longest)) for t in sent.value], axis=1)
        rows = np.repeat(np.arange(len(points)), most)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(np.take_along_axis(scores, top, 1).ravel()),
             pa.array(list(where[top.ravel()]), pa.list_(pa.int64()))],
            ["q", "score", "leaves"],
        )

    found = entries.select("vector").mapInArrow(best, "q long, score double, leaves array<long>")
    # The best of all is the query itself, or its equal: one more than k is looked at.
    true = found.groupBy("q").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "leaves"))), 2, k).alias("best")
    ).select("q", F.col("best.leaves").alias("wanted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, wanted in zip(batch.column("q").to_pylist(), batch.column("wanted").to_pylist()):
                met = opened_until(sent.value, lifted(points[q : q + 1], longest, query=True)[0],
                                   np.array(wanted, np.int64).reshape(len(wanted), -1))
                yield pa.RecordBatch.from_arrays([pa.array(met)], ["opened"])

    opened = sorted(r[0] for r in true.repartition(n, "q").mapInArrow(count, "opened long").collect())
    return opened[min(len(opened) - 1, int(recall * len(opened)))] if opened else 1


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = (
        F.col(id_col).isNotNull() & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    # Single precision stays as it is until it is computed with: half the bytes to move.
    kind = vectors.schema[vector].dataType.simpleString()
    kept = F.col(vector) if kind == "array<float>" else v
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), kept.alias("vector"),
                          F.coalesce(fine, F.lit(False)).alias("fine")).where("fine").drop("fine")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def met_in_cell(left: pa.Table, right: pa.Table, dim: int, k: int) -> pa.Table:
    """query_id, vec_id, score: for each query (query_id, vector, leaves, least) of a cell its ``k`` best entries
    (leaf, vector, ids) of the leaves it opens there, and those that tie with the last one, if they reach ``least``.

    An entry of no id but the query's own counts for nothing.
    """
    out = []
    if left.num_rows and right.num_rows:
        column = right.column("ids").combine_chunks()
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        members = column.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        alone = members[starts] == members[starts + sizes - 1]  # ids are in order
        data, asks = (matrix(t.column("vector").combine_chunks(), dim) for t in (right, left))
        names, least = left.column("query_id").to_numpy(), left.column("least").to_numpy().copy()
        leaf_of = right.column("leaf").to_numpy()
        in_leaf = np.argsort(leaf_of, kind="stable")
        opened = left.column("leaves").combine_chunks()
        askers = np.repeat(np.arange(len(asks)), opened.value_lengths().to_numpy(zero_copy_only=False))
        opened = opened.flatten().to_numpy(zero_copy_only=False)
        # Sums in another order differ in their last digits, so what is that near a limit stays in.
        below = lambda x: x - 1e-9 * np.where(np.isfinite(x), np.abs(x), 0)
        for a in range(0, len(asks), 512):
            part = slice(*np.searchsorted(askers, [a, a + 512]))
            by = np.argsort(opened[part], kind="stable")
            of, who = opened[part][by], askers[part][by]
            kinds, begins = np.unique(of, return_index=True)
            rows = np.searchsorted(leaf_of[in_leaf], [kinds, kinds + 1])
            hits = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
            for x, y, r0, r1 in zip(begins, [*begins[1:], len(of)], *rows):
                q, e = who[x:y], in_leaf[r0:r1]
                if not len(e):
                    continue
                near = asks[q] @ data[e].T
                near[alone[e] & (names[q][:, None] == members[starts[e]])] = -np.inf
                if len(e) >= k:
                    least[q] = np.maximum(least[q], np.partition(near, -k, axis=1)[:, -k])
                i, j = np.nonzero((near >= below(least[q])[:, None]) & (near > -np.inf))
                hits.append((q[i], e[j], near[i, j]))
            q, e, score = (np.concatenate(h) for h in zip(*hits))
            by = np.lexsort((-score, q))
            q, e, score = q[by], e[by], score[by]
            first = np.searchsorted(q, q)
            last = np.minimum(first + k, np.searchsorted(q, q, side="right")) - 1
            keep = score >= below(score[last])
            q, e = q[keep], e[keep]
            exact = (asks[q] * data[e]).sum(axis=1)
            at = np.repeat(starts[e] - np.cumsum(sizes[e]) + sizes[e], sizes[e]) + np.arange(sizes[e].sum())
            out.append((np.repeat(names[q], sizes[e]), members[at], np.repeat(exact, sizes[e])))
    columns = [np.concatenate(c) for c in zip(*out)] or [[], [], []]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                     "score": pa.array(columns[2], pa.float64())})


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    queries: Column | None = None,
    k: int = NEAREST,
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    leaves: int | None = None,
    sample: int = SAMPLE,
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: up to ``k`` vectors of largest inner product found.

    ``queries`` tells which rows ask (on vec_id; default: ids divisible by 20). A query never finds
    its own row. Ties go to the smaller vec_id. Null, zero and broken vectors (null or non-finite
    components), rows without id, and vectors whose dimension is not the commonest one take no
    part. Rows of one id and one vector are one candidate, and so are other vectors of that id each;
    queries of one id share one list. An empty table gives an empty result.

    Each query opens ``leaves`` leaves; by default as many as hold ``recall`` of the true neighbours
    of ``MEASURED_ON`` queries, whatever the table's size and shape.

    Equal vectors are one entry of the index with its k + 1 smallest ids: no other id of the entry
    can be among a query's k nearest. So a vector that many rows share fills no leaf. Leaf sizes
    follow from the median splits; neighbouring leaves meet their queries as one cell, and a cell's queries
    are dealt over blocks, so no task holds more than a cell and a block.
    """
    spark = prepared(vectors.sparkSession)
    rows = usable(vectors, id_col, vector)
    dims = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if dims is None:
        return spark.createDataFrame([], schema)
    dim = dims["dim"]
    rows = rows.where(F.size("vector") == dim)
    kind = rows.schema["vector"].dataType.simpleString()
    # The ids of one vector: each partial list keeps k + 1 of them, so a common vector stays small.
    entries = staged(
        rows.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt"))
        .agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"))
        .groupBy("vector")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
        .select(F.monotonically_increasing_id().alias("entry"), "vector", "ids"),
        "entries",
    )
    stats = entries.agg(
        F.max(F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x)), F.count("*")
    ).first()
    longest, n_entries = stats
    fit_on = entries.orderBy(F.xxhash64("vector"), "entry").limit(sample).select("vector").toArrow()
    points = lifted(np.array(fit_on.column(0).to_pylist(), np.float64), longest)
    rng = np.random.default_rng(11)
    # As many rows of the sample in a leaf as stand for leaf_rows of all.
    share = max(1, leaf_rows * len(points) // max(n_entries, 1))
    forest = [grow(points, share, rng) for _ in range(trees)]
    sent = spark.sparkContext.broadcast(forest)

    def by_cell(wanted: int) -> list[int]:
        """How many neighbouring leaves of each tree make a cell of about ``CELL_ROWS`` entries."""
        return [max(1, CELL_ROWS * (len(t.limits) + 1) // n_entries) for t in forest[:wanted]]

    def place(of: list[int]):
        """Each vector once per tree."""

        def work(batches):
            for batch in batches:
                own, n = lifted(matrix(batch.column("vector"), dim), longest), batch.num_rows
                where = np.stack([t.leaves(own) for t in sent.value[: len(of)]], axis=1).astype(np.int64)
                take = pa.array(np.repeat(np.arange(n), len(of)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(len(of), dtype=np.int32), n)),
                     pa.array((where // np.array(of)).ravel()), pa.array(where.ravel()),
                     batch.column("vector").take(take), batch.column("ids").take(take)],
                    ["tree", "cell", "leaf", "vector", "ids"],
                )

        return work

    def ask(of: list[int], most: int):
        """Each query once per cell, with the leaves it opens there: ``most`` at most, of the trees of ``of``."""

        def work(batches):
            for batch in batches:
                own = lifted(matrix(batch.column("vector"), dim), longest, query=True)
                cells, at = [], []
                for i, q in enumerate(own):
                    opened: dict[tuple[int, int], list[int]] = {}
                    of_trees = (x for x in search(sent.value, q, leaves) if x[0] < len(of))
                    for t, leaf in islice(of_trees, most):
                        opened.setdefault((t, leaf // of[t]), []).append(leaf)
                    cells += opened.items()
                    at += [i] * len(opened)
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for (t, _), _ in cells], pa.int32()), pa.array([c for (_, c), _ in cells], pa.int64()),
                     pa.array([x for _, x in cells], pa.list_(pa.int64())),
                     *(batch.column(c).take(at) for c in ("query_id", "vector", "least"))],
                    ["tree", "cell", "leaves", "query_id", "vector", "least"],
                )

        return work

    asked = rows.where(F.col("vec_id") % 20 == 0 if queries is None else queries)
    asked = asked.select(F.col("vec_id").alias("query_id"), "vector")
    if leaves is None:
        leaves = leaves_for(recall, asked, entries, sent, k, dim, longest)
    n_asked = asked.count()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return met_in_cell(left, right, dim, k)

    def candidates(asking: DataFrame, n_trees: int, most: int) -> DataFrame:
        """query_id, vec_id, score of what the opened leaves of ``n_trees`` trees hold (of ``most`` leaves), some
        ``k`` for each query and cell."""
        of = by_cell(n_trees)
        n_cells = sum(-(-(len(t.limits) + 1) // c) for t, c in zip(forest, of))
        # Queries of a cell in blocks of some thousands: cells and entries of a query set its mean number.
        blocks = 1 + n_asked * min(most, n_cells) // (n_cells * 4096)
        index = entries.mapInArrow(place(of), f"tree int, cell long, leaf long, vector {kind}, ids array<long>")
        index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(int(blocks) - 1))))
        questions = asking.mapInArrow(
            ask(of, most), f"tree int, cell long, leaves array<long>, query_id long, vector {kind}, least double"
        ).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(int(blocks))).cast("int"))
        return (
            questions.groupBy("tree", "cell", "block")
            .cogroup(index.groupBy("tree", "cell", "block"))
            .applyInArrow(meet, "query_id long, vec_id long, score double")
            .where(F.col("vec_id") != F.col("query_id"))
            .distinct()
        )

    # Some of the leaves that are opened in one tree tell how near a query's k-th nearest is at least. Of all other leaves only what
    # is not farther counts, so the rows that leave them do not grow with the number of leaves.
    none = float("-inf")
    first = candidates(asked.withColumn("least", F.lit(none)), 1, FIRST_LEAVES)
    bound = staged(
        first.groupBy("query_id")
        .agg(F.slice(F.array_sort(F.collect_list(-F.col("score"))), 1, k).alias("s"))
        .where(F.size("s") == k)
        .select("query_id", (-F.element_at("s", -1)).alias("least")),
        "least-scores",
    )
    asking = asked.join(bound, "query_id", "left").select("query_id", "vector", F.coalesce("least", F.lit(none)).alias("least"))
    found = candidates(asking, trees, leaves)
    best = (
        found.groupBy("query_id")
        .agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("b"))
        .select("query_id", F.posexplode("b").alias("p", "b"))
    )
    return best.select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        (-F.col("b.s")).alias("score"),
    )


def lifted(vectors: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
    more = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(longest - (vectors**2).sum(axis=1), 0))
    return np.column_stack([vectors, more])

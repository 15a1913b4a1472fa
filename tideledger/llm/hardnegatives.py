"""Hard negatives: vectors of other labels that score nearly as high as an anchor's positives.

Candidates lie in blocks of some thousand rows, one Parquet row each, ordered by label and then along
a Hilbert curve, so that a block covers a small box. Its zone map is that box: the minimum and
maximum of every dimension, and of the labels. Interval arithmetic on the box bounds the inner
product of an anchor with anything in the block from above and below, and an anchor reads a block
only if the bounds meet what it looks for:

* positives: the upper bound reaches the anchor's k-th best score in its own block;
* negatives: the bounds meet the window of one of the anchor's positives.

Bounds never exclude a row that belongs to the result, so it is exact. Anchors are dealt in groups
along the curve; a group and a few blocks meet in a task, which returns the best few per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.llm.clustering import BATCHES
from tideledger.llm.text import prepared
from tideledger.operators.ranking import globally_numbered
from tideledger.operators.staging import staged

SCALE = 256
BLOCK_ROWS = 2048
GROUP_ANCHORS = 4096
# Zone maps and blocks that meet one group of anchors in a task.
ZONES_AT_ONCE = 1024
BLOCKS_AT_ONCE = 4
HILBERT_BITS = 4
# Scores of anchors in one go: 16 MB for a block.
SCORED_AT_ONCE = 1024
LEAST = np.iinfo(np.int64).min

BLOCK = ("dim int, label_lo long, label_hi long, lo array<long>, hi array<long>, "
         "labels array<long>, ids array<long>, cells binary")
ANCHOR = "block long, slot int, anchor_id long, label long, cells array<long>, least long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Rules:
    """Every ``every``-th id asks; ``low`` and ``high`` are percents of the positive's score."""

    every: int = 100
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100

    def window(self, score: int) -> tuple[int, int]:
        """The least and largest score with low * score <= 100 * s <= high * score."""
        return -(-self.low * score // 100), self.high * score // 100


def hilbert_keys(cells: np.ndarray, bits: int = HILBERT_BITS) -> np.ndarray:
    """Places of grid cells (n x dim, ``bits`` bits each) on the Hilbert curve, as bytes that sort
    like the places."""
    n, dim = cells.shape
    x = cells.T.astype(np.uint32).copy()
    for bit in range(bits - 1, 0, -1):
        q, p = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for i in range(dim):
            turned = (x[i] & q) != 0
            swap = np.where(turned, np.uint32(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(turned, p, swap)
            x[i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros(n, np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1), np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= flip
    planes = [(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` and ``b``, through floats where those are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest inner product of each anchor with any point of each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return dot(up, lo) + dot(down, hi), dot(up, hi) + dot(down, lo)


def ordered_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """vec_id, label and vector in blocks along (dimension, label, Hilbert curve), with zone maps."""
    ends = rows.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    low, high = (float(x or 0) for x in ends)
    dims = int(rows.agg(F.max(F.size("vector"))).first()[0] or 0)
    if max(abs(low), abs(high)) ** 2 * max(dims, 1) >= 2.0**62:
        raise ValueError("scaled components are so large that scores may leave 64 bits")
    step = max(high - low, 1.0) / ((1 << HILBERT_BITS) - 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            at = np.cumsum(sizes) - sizes
            keys = np.full(batch.num_rows, b"", object)
            for dim in np.unique(sizes[sizes > 0]):
                mine = np.flatnonzero(sizes == dim)
                own = flat[at[mine][:, None] + np.arange(dim)]
                cells = np.floor((own - low) / step).astype(np.int64)
                keys[mine] = [k.tobytes() for k in hilbert_keys(cells)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(keys.tolist(), pa.binary())],
                ["vec_id", "label", "vector", "dim", "place"],
            )

    def block(batch: pa.RecordBatch, dim: int) -> pa.RecordBatch:
        cells = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
        cells = cells.reshape(batch.num_rows, dim).astype(np.int64)
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        one = lambda values, kind: pa.array([values], kind)
        many = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [one(dim, pa.int32()), one(int(labels.min()), pa.int64()), one(int(labels.max()), pa.int64()),
             one(cells.min(axis=0), many), one(cells.max(axis=0), many), one(labels, many),
             one(batch.column("ids").to_numpy(zero_copy_only=False), many),
             one(cells.astype(np.int32).tobytes(), pa.binary())],
            ["dim", "label_lo", "label_hi", "lo", "hi", "labels", "ids", "cells"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of one dimension each, full but for the last ones."""
        held: pa.Table | None = None
        for batch in batches:
            own = pa.table({"ids": batch.column("vec_id"), "label": batch.column("label"),
                            "vector": batch.column("vector"), "dim": batch.column("dim")})
            held = own if held is None else pa.concat_tables([held, own])
            while held.num_rows >= block_rows:
                yield from by_dim(held.slice(0, block_rows))
                held = held.slice(block_rows)
        if held is not None and held.num_rows:
            yield from by_dim(held)

    def by_dim(part: pa.Table) -> Iterator[pa.RecordBatch]:
        dims_of = part.column("dim").to_numpy()
        starts = np.flatnonzero(np.diff(dims_of, prepend=dims_of[0] - 1))
        for a, b in zip(starts, [*starts[1:], len(dims_of)]):
            yield block(part.slice(a, b - a).combine_chunks().to_batches()[0], int(dims_of[a]))

    kind = rows.schema["vector"].dataType.simpleString()
    placed = staged(
        rows.mapInArrow(keyed, f"vec_id long, label long, vector {kind}, dim int, place binary")
        .withColumn("at", F.monotonically_increasing_id()),
        "on-curve",
    )
    # The last two columns cut a vector that many rows share.
    order = ["dim", "label", "place", "vec_id", "at"]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                placed.count() // (64 * block_rows) + 1)
    cut_up = (
        placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .select("vec_id", "label", "vector", "dim").mapInArrow(cut, BLOCK)
    )
    return staged(cut_up.withColumn("block", F.monotonically_increasing_id()), "blocks")


class Block:
    def __init__(self, batch: pa.RecordBatch | pa.Table, i: int):
        value = lambda c: batch.column(c)[i]
        self.dim = value("dim").as_py()
        self.block = value("block").as_py()
        self.labels = value("labels").values.to_numpy(zero_copy_only=False)
        self.ids = value("ids").values.to_numpy(zero_copy_only=False)
        self.cells = np.frombuffer(value("cells").as_py(), np.int32).reshape(-1, self.dim).astype(np.int64)


def anchors_of(blocks: DataFrame, rules: Rules) -> DataFrame:
    """The rows that ask, with the score that their k-th positive reaches at least: the k-th best of
    their own block, or the least number where that has fewer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = Block(batch, i)
                asks = np.flatnonzero(b.ids % rules.every == 0)
                least = np.full(len(asks), LEAST)
                for a in range(0, len(asks), SCORED_AT_ONCE):
                    scores = dot(b.cells[asks[a : a + SCORED_AT_ONCE]], b.cells)
                    for j, row in enumerate(asks[a : a + SCORED_AT_ONCE]):
                        same = b.labels == b.labels[row]
                        same[row] = False
                        own = scores[j, same]
                        if len(own) >= rules.positives:
                            least[a + j] = np.partition(own, -rules.positives)[-rules.positives]
                cells = pa.array(list(b.cells[asks]), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(asks), b.block)), pa.array(asks.astype(np.int32)),
                     pa.array(b.ids[asks]), pa.array(b.labels[asks]), cells, pa.array(least)],
                    ["block", "slot", "anchor_id", "label", "cells", "least"],
                )

    found = staged(
        blocks.select("block", "dim", "labels", "ids", "cells").mapInArrow(work, ANCHOR), "anchors"
    )
    return globally_numbered(found, ["block", "slot"], "n").select(
        "*", F.floor(F.col("n") / GROUP_ANCHORS).cast("long").alias("group")
    ).drop("n")


class Group:
    """The anchors of a group; those of one dimension as a matrix."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        column = lambda c: table.column(c).to_numpy()
        self.block, self.slot, self.label = column("block"), column("slot"), column("label")
        self.anchor_id, self.least = column("anchor_id"), column("least")
        cells = table.column("cells").to_pylist()
        sizes = np.array([len(c) for c in cells], np.int64)
        self.by_dim = {
            int(d): (np.flatnonzero(sizes == d),
                     np.array([c for c in cells if len(c) == d], np.int64).reshape(-1, int(d)))
            for d in np.unique(sizes)
        }
        positives = "positive_scores" in table.column_names
        self.positive_ids = table.column("positive_ids").to_pylist() if positives else None
        self.scores = table.column("positive_scores").to_pylist() if positives else None


def wants_positives(group: Group, mine: np.ndarray, rules: Rules, least, most, label_lo, label_hi):
    """Which of the group's anchors read which blocks: ``least`` and ``most`` bound their scores."""
    label = group.label[mine][:, None]
    return (label >= label_lo) & (label <= label_hi) & (most >= group.least[mine][:, None])


def wants_negatives(group: Group, mine: np.ndarray, rules: Rules, least, most, label_lo, label_hi):
    label = group.label[mine][:, None]
    wanted = np.zeros(most.shape, bool)
    for p in range(rules.positives):
        has = np.array([len(group.scores[i]) > p for i in mine], bool)
        windows = [rules.window(group.scores[i][p]) if h else (1, 0) for i, h in zip(mine, has)]
        low, high = np.array(windows, np.int64).reshape(-1, 2).T[:, :, None]
        wanted |= has[:, None] & (low <= high) & (most >= low) & (least <= high)
    return wanted & ~((label_lo == label) & (label_hi == label))


def asked(blocks: DataFrame, anchors: DataFrame, rules: Rules, wants) -> DataFrame:
    """block, group and the group's members that read the block, by zone maps alone."""
    groups = int(anchors.agg(F.max("group")).first()[0])
    # Block numbers have gaps, so zone maps are dealt by hash.
    chunks = max(1, blocks.count() // ZONES_AT_ONCE)
    zones = blocks.select(
        "block", "dim", "label_lo", "label_hi", "lo", "hi",
        F.pmod(F.xxhash64("block"), F.lit(chunks)).alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(groups)).cast("array<long>")).alias("group"),
    )
    asking = anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<long>")))

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            group = Group(left.sort_by([("block", "ascending"), ("slot", "ascending")]))
            dims = right.column("dim").to_numpy()
            for dim, (mine, cells) in group.by_dim.items():
                here = np.flatnonzero(dims == dim)
                if not len(here):
                    continue
                zone = right.take(pa.array(here)).combine_chunks()
                lo, hi = (zone.column(c).combine_chunks().flatten().to_numpy().reshape(-1, dim)
                          for c in ("lo", "hi"))
                least, most = bounds(cells, lo, hi)
                wanted = wants(group, mine, rules, least, most, zone.column("label_lo").to_numpy(),
                               zone.column("label_hi").to_numpy())
                for block, column in zip(zone.column("block").to_pylist(), wanted.T):
                    if column.any():
                        found.append((key[1].as_py(), block, mine[column].astype(np.int32)))
        group_of, block, members = zip(*found) if found else ((), (), ())
        return pa.table({"group": pa.array(group_of, pa.int64()), "block": pa.array(block, pa.int64()),
                         "members": pa.array(members, pa.list_(pa.int32()))})

    return staged(
        asking.groupBy("chunk", "group").cogroup(zones.groupBy("chunk", "group"))
        .applyInArrow(meet, "group long, block long, members array<int>"),
        "asked",
    )


def met(blocks: DataFrame, anchors: DataFrame, asks: DataFrame, schema: str, work) -> DataFrame:
    """What ``work(group, block, members)`` yields for each group and each block it reads."""
    # The share of blocks that a group reads in a task: whole groups stand beside a few blocks.
    parts = max(1, blocks.count() // BLOCKS_AT_ONCE)
    part = F.pmod(F.xxhash64("block"), F.lit(parts))
    read = blocks.drop("lo", "hi", "label_lo", "label_hi").join(asks, "block").withColumn("part", part)
    pairs = asks.select(F.col("group").alias("of"), part.alias("beside")).distinct()
    asking = pairs.join(anchors, F.col("of") == F.col("group")).drop("group")
    names = [c.split()[0] for c in schema.split(", ")]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in names}
        if left.num_rows and right.num_rows:
            group = Group(left.sort_by([("block", "ascending"), ("slot", "ascending")]))
            for i in range(right.num_rows):
                members = right.column("members")[i].values.to_numpy(zero_copy_only=False)
                for row in work(group, Block(right, i), members):
                    for c, values in zip(names, row):
                        out[c].append(values)
        kinds = {"int": pa.int32(), "long": pa.int64()}
        return pa.table({
            c: pa.array(np.concatenate(out[c]) if out[c] else [], kinds[kind.split()[1]])
            for c, kind in zip(names, schema.split(", "))
        })

    return staged(
        asking.groupBy("of", "beside").cogroup(read.groupBy("group", "part")).applyInArrow(meet, schema),
        "met",
    )


def scored(group: Group, block: Block, members: np.ndarray):
    """Each member with its scores in the block."""
    mine, cells = group.by_dim[block.dim]
    rows = np.searchsorted(mine, members)
    for a in range(0, len(members), SCORED_AT_ONCE):
        scores = dot(cells[rows[a : a + SCORED_AT_ONCE]], block.cells)
        yield from zip(members[a : a + SCORED_AT_ONCE], scores)


def positives(blocks: DataFrame, anchors: DataFrame, rules: Rules) -> DataFrame:
    """``anchors`` with positive_ids and positive_scores, best first; those without any go."""

    def work(group: Group, block: Block, members: np.ndarray):
        for i, scores in scored(group, block, members):
            fits = (block.labels == group.label[i]) & (scores >= group.least[i])
            if group.block[i] == block.block:
                fits[group.slot[i]] = False
            at = np.flatnonzero(fits)
            at = at[np.lexsort((block.ids[at], -scores[at]))][: rules.positives]
            one = np.ones(len(at), np.int64)
            yield one * group.block[i], one.astype(np.int32) * group.slot[i], block.ids[at], scores[at]

    asks = asked(blocks, anchors, rules, wants_positives)
    found = met(blocks, anchors, asks, "block long, slot int, vec_id long, score long", work)
    best = best_of(found, ["block", "slot"], rules.positives).select(
        "block", "slot", F.col("best.vec_id").alias("positive_ids"),
        F.transform("best.minus", lambda m: -m).alias("positive_scores"),
    )
    return staged(anchors.join(best, ["block", "slot"]), "with-positives")


def best_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best of each key: highest score, ties to the smaller vec_id."""
    entry = F.struct((-F.col("score")).alias("minus"), "vec_id")
    return found.groupBy(*keys).agg(
        F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best")
    )


def negatives(blocks: DataFrame, anchors: DataFrame, rules: Rules) -> DataFrame:
    """The first few rows of other labels in the window of each positive."""

    def work(group: Group, block: Block, members: np.ndarray):
        for i, scores in scored(group, block, members):
            own = group.scores[i]
            windows = [rules.window(s) for s in own]
            low, high = min(w[0] for w in windows), max(w[1] for w in windows)
            at = np.flatnonzero((block.labels != group.label[i]) & (scores >= low) & (scores <= high))
            at = at[np.lexsort((block.ids[at], -scores[at]))]
            minus = -scores[at]
            for p, (a, b) in enumerate(windows):
                first, last = np.searchsorted(minus, -b), np.searchsorted(minus, -a, "right")
                hit = at[first : max(first, min(last, first + rules.negatives))]
                one = np.ones(len(hit), np.int64)
                yield (one * group.block[i], one.astype(np.int32) * group.slot[i],
                       one.astype(np.int32) * p, block.ids[hit], scores[hit])

    asks = asked(blocks, anchors, rules, wants_negatives)
    found = met(blocks, anchors, asks, "block long, slot int, p int, vec_id long, score long", work)
    best = best_of(found, ["block", "slot", "p"], rules.negatives)
    named = anchors.select(
        "block", "slot", "anchor_id", F.posexplode(F.arrays_zip("positive_ids", "positive_scores")).alias("p", "positive")
    )
    return best.join(named, ["block", "slot", "p"]).select(
        "anchor_id", F.col("positive.positive_ids").alias("positive_id"),
        F.col("positive.positive_scores").alias("positive_score"), F.posexplode("best").alias("r", "b"),
    ).select(
        "anchor_id", "positive_id", (F.col("r") + 1).cast("int").alias("rank"),
        F.col("b.vec_id").alias("negative_id"), "positive_score", (-F.col("b.minus")).alias("negative_score"),
    )


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    rules: Rules = Rules(),
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    Anchors are the rows whose id is divisible by ``rules.every``. A score is the inner product of
    the integers floor(scale * x); higher comes first, ties go to the smaller id. An anchor's
    positives are its first few other rows of the same label; for each, the first few rows of other
    labels whose score lies within ``low`` to ``high`` percent of the positive's are returned. Rows
    without id or label, or with a null, broken or empty vector take no part; vectors of different
    length never meet. Repeated ids are rows of their own, so an anchor that is there twice has the
    other one as a positive, and its results are returned twice. Scores that could leave 64 bits
    raise ValueError. An empty table gives an empty result.
    """
    spark = prepared(vectors.sparkSession)
    usable = vectors.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = usable.where((F.size(v) > 0) & ~broken).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x)).alias("vector"),
    )
    before = spark.conf.get(BATCHES)
    blocks = ordered_blocks(rows, block_rows)
    try:
        # Blocks of half a megabyte: few go to Python at a time.
        spark.conf.set(BATCHES, 16)
        anchors = staged(anchors_of(blocks, rules), "grouped-anchors")
        if anchors.isEmpty():
            return spark.createDataFrame([], RESULT)
        with_positives = positives(blocks, anchors, rules)
        if with_positives.isEmpty():
            return spark.createDataFrame([], RESULT)
        return staged(negatives(blocks, with_positives, rules), "hard-negatives")
    finally:
        spark.conf.set(BATCHES, before)

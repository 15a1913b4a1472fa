"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.operators.staging import staged

# Edges a task holds at a time.
CHUNK_EDGES = 200_000


def ranked(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A code for each value, in the values' order, and where each code is first found."""
    fields = values.flatten() if pa.types.is_struct(values.type) else [values]
    names = [str(i) for i in range(len(fields))]
    order = pc.sort_indices(
        pa.table(fields, names), sort_keys=[(name, "ascending") for name in names]
    ).to_numpy()
    fresh = np.zeros(len(values), bool)
    fresh[:1] = True
    for field in fields:
        field = field.take(pa.array(order))
        fresh[1:] |= pc.not_equal(field[1:], field[:-1]).to_numpy(zero_copy_only=False)
    codes = np.empty(len(values), np.int64)
    codes[order] = np.cumsum(fresh) - 1
    return codes, order[fresh]


def stars(chunk: pa.Table) -> pa.Table:
    """The edges of a chunk as stars: each node linked to the smallest of its component there."""
    ends = pa.concat_arrays(
        [piece for name in ("a", "b") for piece in chunk.column(name).chunks]
    )
    codes, found = ranked(ends)
    a, b = codes[: len(chunk)], codes[len(chunk) :]
    label = np.arange(len(found))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label = label[label]
    leaves = np.flatnonzero(label != np.arange(len(found)))
    return pa.table({"a": ends.take(pa.array(found[leaves])),
                     "b": ends.take(pa.array(found[label[leaves]]))})


def contracted(edges: DataFrame) -> DataFrame:
    """Edges with the same components, each task's edges in chunks turned into stars."""

    def work(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK_EDGES:
                yield from stars(pa.Table.from_batches(held)).to_batches()
                held, rows = [], 0
        if rows:
            yield from stars(pa.Table.from_batches(held)).to_batches()

    return edges.mapInArrow(work, edges.schema)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges(a, b)``: columns node, root.

    Alternates two steps until only stars are left: every node links its larger neighbours, then
    its smaller ones, to the smallest node it knows. The number of rounds grows with the logarithm of
    the longest path. Each round is two grouped minima joined back to the edges (a side of unique
    keys, so a hub with many edges is split by the engine) and a written table, which cuts the
    lineage. Before and after its edges are dealt out, each task turns those it holds into stars,
    which shortens paths without a shuffle. An edge with a null end or from a node to itself links
    nothing.
    """
    now = dealt(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )
    while not all_stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        wide = (
            both.join(least, "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        now = dealt(
            wide.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                    .alias("e"))
            .select("e.a", "e.b")
            .where(F.col("a") != F.col("b"))
        )
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def dealt(edges: DataFrame) -> DataFrame:
    """The same components in fewer edges, as a written table."""
    return staged(contracted(contracted(edges).distinct()), "edges")


def all_stars(edges: DataFrame) -> bool:
    """Whether each larger end ``a`` has one edge and is no other edge's smaller end ``b``."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    loose = nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    return loose.agg(F.count("*")).first()[0] == 0

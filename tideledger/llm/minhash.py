"""Near-duplicate documents by fast similarity sketches, bands and exact verification.

A document is its set of distinct word shingles. Documents with equal sets form a class, which
takes part once. A sketch has ``coordinates`` places, filled in rounds: round ``i`` hashes every
shingle anew to a place and a value, and a place keeps the smallest value of the first round that
reaches it. After ``coordinates`` rounds every further round sends all shingles to one fixed
place, so each place is filled. Places agree with a probability equal to the sets' similarity.

Runs of ``rows`` coordinates are bands; classes that agree in a band are candidates. Candidates are
closed to clusters, and inside a cluster every set is compared exactly. A large cluster is split in
blocks, and each pair of blocks is one task, so a task never holds more than two blocks. Tasks
return links that span what they found, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger.llm.components import components
from tideledger.llm.text import (
    byte_texts, each_batch, lists, mix, nth, prepared, shingle_hashes, signed, texts_of, word_hashes,
    words_of,
)
from tideledger.operators.staging import staged

SEED = np.uint64(0x2545F4914F6CDD1D)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
VALUE_BITS = np.uint64(48)
VALUE_MASK = np.uint64((1 << 48) - 1)
HALF = np.uint64(32)
# Shingles of all documents of one block of a large cluster: 16 MB.
BLOCK_SHINGLES = 2_000_000


def shingle_set(text: bytes, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(words_of(text)), width))


def sketches(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` values for each set; a row of an empty set stays EMPTY."""
    n = len(sets)
    out = np.full(n * coordinates, EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate([*sets, np.empty(0, np.uint64)])
    owners = np.repeat(np.arange(n), sizes)
    for i in range(2 * coordinates):
        if not len(elements):
            break
        x = mix(elements ^ nth(2 * i + 1))
        if i < coordinates:
            place = (((x >> HALF) * np.uint64(coordinates)) >> HALF).astype(np.int64)
        else:
            place = i - coordinates
        np.minimum.at(out, owners * coordinates + place,
                      (np.uint64(i) << VALUE_BITS) | (x & VALUE_MASK))
        open_rows = (out.reshape(n, coordinates) == EMPTY).any(axis=1)
        left = open_rows[owners]
        elements, owners = elements[left], owners[left]
    return out.reshape(n, coordinates)


def band_keys(rows_of_values: np.ndarray, rows: int) -> np.ndarray:
    """A key for each run of ``rows`` coordinates; equal keys in different bands never meet."""
    n, coordinates = rows_of_values.shape
    parts = rows_of_values.reshape(n, coordinates // rows, rows)
    acc = np.arange(coordinates // rows, dtype=np.uint64)[None, :] * SEED
    for j in range(rows):
        acc = mix(acc ^ parts[:, :, j])
    return acc


def sketched(docs: DataFrame, width: int, coordinates: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, class_key (null for an empty set) and band keys of each document."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, width) for t in byte_texts(batch, "text")]
        sizes = np.array([len(s) for s in sets], np.int64)
        keys = band_keys(sketches(sets, coordinates), rows)
        full = sizes > 0
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes),
                pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None
                          for s in sets], pa.string()),
                lists(signed(np.ascontiguousarray(keys[full]).ravel()), full * keys.shape[1],
                      pa.int64()),
            ],
            ["doc_id", "n_shingles", "class_key", "bands"],
        )

    return docs.mapInArrow(
        each_batch(work),
        "doc_id long, n_shingles long, class_key string, bands array<long>",
    )


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """class_key and the shingles of each document."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, width) for t in byte_texts(batch, "text")]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets], pa.string()),
                lists(signed(np.concatenate(sets)), np.array([len(s) for s in sets]), pa.int64()),
            ],
            ["class_key", "shingles"],
        )

    return docs.mapInArrow(each_batch(work), "class_key string, shingles array<long>")


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is similar enough.

    Sets are compared through an index from shingle to sets. First what the largest set reaches is
    followed until that adds little; then every set outside the largest group is compared with all.
    Both ends of a link see it, so nothing is lost.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(codes, kind="stable")
    holders = np.repeat(np.arange(n), sizes)[order]
    starts = np.searchsorted(codes[order], np.arange(len(values) + 1))
    at = np.concatenate([[0], np.cumsum(sizes)])

    def similar(i: int) -> np.ndarray:
        mine = codes[at[i] : at[i + 1]]
        counts = starts[mine + 1] - starts[mine]
        flat = np.repeat(starts[mine] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        shared = np.bincount(holders[flat + np.arange(len(flat))], minlength=n)
        hit = 100 * shared >= percent * (sizes[i] + sizes - shared)
        hit[i] = False
        return np.flatnonzero(hit)

    links: list[tuple[int, int]] = []
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def follow(i: int) -> list[int]:
        new = []
        for j in similar(i):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, int(j)))
                new.append(int(j))
        return new

    seen = np.zeros(n, bool)
    frontier, idle = [int(np.argmax(sizes))], 0
    while frontier and idle < 8 and not seen.all():
        i = frontier.pop(0)
        seen[i] = True
        new = follow(i)
        idle = 0 if new else idle + 1
        frontier += new
    group = np.array([root(i) for i in range(n)])
    largest = np.bincount(group).argmax()
    for i in np.flatnonzero((group != largest) & ~seen):
        follow(int(i))
    return links


def cluster_links(members: DataFrame, percent: int) -> DataFrame:
    """Verified links inside clusters: members(cluster, block_a, block_b, class_key, shingles)."""

    def work(table: pa.Table) -> pa.Table:
        keys = table.column("class_key").to_pylist()
        column = table.column("shingles").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        sets = np.split(flat, ends[:-1])
        links = spanning_links(sets, percent)
        return pa.table(
            {"a": pa.array([keys[i] for i, _ in links], pa.string()),
             "b": pa.array([keys[j] for _, j in links], pa.string())}
        )

    return members.groupBy("cluster", "block_a", "block_b").applyInArrow(
        work, "a string, b string"
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    coordinates: int = 128,
    rows: int = 4,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``.

    Two documents are linked if their shingle sets' similarity is ``percent`` or more; a component
    is what links connect, named by its smallest id. One row comes out for each row that goes in,
    also for repeated ids and equal texts. A null or empty text has no shingles and is linked with
    nothing: it is its own component. A null id stays null; it names a component only if no member
    has an id. An empty table gives an empty result.

    The chance to miss a link just at the limit is (1 - s**rows) ** (coordinates / rows), with
    s the similarity: 5e-8 for the default of four rows at 0.8, 2e-7 for five rows and 130
    coordinates at 0.85.
    """
    spark = prepared(docs.sparkSession)
    texts = texts_of(docs, id_col, text_col)
    rows_of_docs = staged(sketched(texts, width, coordinates, rows), "sketches")
    classes = (
        rows_of_docs.where(F.col("class_key").isNotNull())
        .groupBy("class_key")
        .agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles"),
             F.first("bands").alias("bands"))
    )
    classes = staged(classes, "classes")
    places = classes.select("class_key", F.explode("bands").alias("band"))
    first = (
        places.groupBy("band")
        .agg(F.min("class_key").alias("a"), F.max("class_key").alias("z"))
        .where(F.col("a") != F.col("z"))
    )
    candidates = (
        places.join(first, "band")
        .where(F.col("class_key") != F.col("a"))
        .select("a", F.col("class_key").alias("b"))
    )
    clusters = components(candidates)
    sized = clusters.select(F.col("node").alias("class_key"), F.col("root").alias("cluster")).join(
        classes.drop("bands"), "class_key"
    )
    sized = staged(sized, "clusters")
    blocks = sized.groupBy("cluster").agg(
        F.ceil(F.sum("n_shingles") / F.lit(block_shingles)).cast("int").alias("n_blocks")
    )
    members = sized.join(blocks, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("class_key"), F.col("n_blocks")).cast("int")
    )
    wanted = sized.select(F.col("first_id").alias("doc_id")).distinct()
    # One strategy at every size: the candidates grow with the input.
    wanted = wanted.hint("merge")
    chosen = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    sets = shingle_sets(chosen.where(F.length("text") > 0), width)
    filled = sets.join(members, "class_key").groupBy("class_key", "cluster", "n_blocks", "block")
    filled = filled.agg(F.first("shingles").alias("shingles"))
    dealt = filled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    dealt = dealt.select(
        "cluster", F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"), "class_key", "shingles",
    )
    links = components(cluster_links(dealt, percent))
    named = classes.select("class_key", "first_id").join(
        links.select(F.col("node").alias("class_key"), "root"), "class_key", "left"
    ).withColumn("root", F.coalesce("root", "class_key"))
    named = staged(named, "named")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = named.join(least, "root").select("class_key", "component_id")
    out = rows_of_docs.drop("bands").join(labels, "class_key", "left")
    component: Column = F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(
        F.col("component_id")
    )
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )

"""A convolutional text classifier on hashed word embeddings, trained in numpy.

A word's vector is the sum of rows of one table: the row its hash names and those of its first
four to seven letters. Filters of several widths slide over the words, each keeps its maximum over the
whole text, and a logistic unit weighs the maxima. All labelled rows train it: they are dealt into
shards of a bounded size, each shard trains a copy in a task, and the copies are averaged after each
round; one shard is plain training. Scoring runs in Arrow batches over whole texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideledger.llm.text import byte_texts, prepared, texts_of, words_of
from tideledger.operators.joins import is_small
from tideledger.operators.ranking import SPLIT_ROWS
from tideledger.operators.staging import staged

# Labelled rows that train one copy in one task. More rows make more shards.
SHARD_ROWS = 12_000
# Up to so many labels go to the texts; beyond that, texts move to their labels.
LABEL_ROWS = 1_000_000
# How often the copies of several shards meet, and the table rows that are averaged in one group.
ROUNDS = 2
PIECE = 1024
TABLE = 1 << 17
DIM = 12
WIDTHS = (1, 2, 3)
INIT = 0.03  # small, so that words never met in training say nothing
DECAY = 1e-3
FILTERS = 6
PREFIXES = (4, 5, 6, 7)
EDGE = b".,;:!?\"'()[]{}<>*#$%&|/\\-_"
CACHE_WORDS = 200_000
BATCH = 32
# Texts whose words are told apart together when a shard is stored.
WORDS_OF = 2_000


def word_rows(word: bytes) -> list[int]:
    """Table rows of a word: one for the whole of it and one for each of its beginnings."""
    bare = (word.strip(EDGE) or word).decode("utf-8", "replace")
    rows = [zlib.crc32(bare.encode()) % (TABLE - 1)]
    for n in PREFIXES:
        rows.append(zlib.crc32(b"^" + bare[:n].encode()) % (TABLE - 1) if len(bare) >= n else TABLE - 1)
    return rows


def words_at(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per text, the place of each word in a list of distinct words, and the table rows of these; short
    texts are padded with the last word, whose rows are empty."""
    place: dict[bytes, int] = {}
    index = []
    for text in texts:
        words = words_of(text)
        for w in words:
            place.setdefault(w, len(place))
        at = np.fromiter(map(place.__getitem__, words), np.int32, len(words))
        index.append(np.pad(at, (0, max(0, max(WIDTHS) - len(at))), constant_values=-1))
    n = 1 + len(PREFIXES)
    rows = np.full((len(place) + 1, n), TABLE - 1, np.int32)
    rows[:-1] = np.fromiter(chain.from_iterable(map(word_rows, place)), np.int32, len(place) * n).reshape(-1, n)
    return index, rows


def rows_of(texts: list[bytes]) -> list[np.ndarray]:
    """Per text, the table rows of each word."""
    index, rows = words_at(texts)
    return [rows[at] for at in index]


class WordVectors:
    """Vectors of the words met so far; forgotten between texts once there are CACHE_WORDS."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.place: dict[bytes, int] = {}
        self.vectors = np.zeros((4096, table.shape[1]), np.float32)

    def of(self, text: bytes) -> np.ndarray:
        words = words_of(text)
        if len(self.place) > CACHE_WORDS:
            self.place.clear()
        place = self.place
        new = [w for w in dict.fromkeys(words) if w not in place]
        if new:
            n = len(place)
            place.update(zip(new, range(n, n + len(new))))
            while len(place) > len(self.vectors):
                self.vectors = np.vstack([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[n : len(place)] = self.table[np.array([word_rows(w) for w in new])].sum(axis=1)
        out = self.vectors[[place[w] for w in words]] if words else self.vectors[:0]
        missing = max(WIDTHS) - len(out)
        if missing > 0:
            out = np.vstack([out, np.zeros((missing, out.shape[1]), np.float32)])
        return out


@dataclass
class Network:
    table: np.ndarray  # TABLE x DIM, the last row stays zero
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: np.ndarray  # of the filters
    weights: np.ndarray
    offset: np.ndarray

    @staticmethod
    def fresh(seed: int) -> Network:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, INIT, (TABLE, DIM)).astype(np.float32)
        table[-1] = 0
        filters = [rng.normal(0, (w * DIM) ** -0.5, (w, DIM, FILTERS)).astype(np.float32)
                   for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return Network(table, filters, np.zeros(n, np.float32),
                       rng.normal(0, n**-0.5, n).astype(np.float32), np.zeros(1, np.float32))

    def copy(self) -> Network:
        return Network(self.table.copy(), [f.copy() for f in self.filters], self.bias.copy(),
                       self.weights.copy(), self.offset.copy())

    def dense(self) -> np.ndarray:
        """All parameters but the table, end to end."""
        return np.concatenate([p.ravel() for p in [*self.filters, self.bias, self.weights, self.offset]])

    def with_dense(self, values: np.ndarray) -> Network:
        """The same table with these parameters."""
        parts = [*self.filters, self.bias, self.weights, self.offset]
        ends = np.cumsum([p.size for p in parts])
        new = [values[e - p.size : e].reshape(p.shape) for e, p in zip(ends, parts)]
        return Network(self.table, new[:-3], *new[-3:])

    def maxima(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter, and where it begins."""
        best, where = [], []
        for f in self.filters:
            n = len(vectors) - len(f) + 1
            out = vectors[:n] @ f[0]
            for j in range(1, len(f)):
                out += vectors[j : n + j] @ f[j]
            at = out.argmax(axis=0)
            where.append(at)
            best.append(out[at, np.arange(FILTERS)])
        return np.concatenate(best) + self.bias, np.concatenate(where)

    def logit(self, vectors: np.ndarray) -> float:
        pooled, _ = self.maxima(vectors)
        return float(np.maximum(pooled, 0) @ self.weights + self.offset[0])


def passes_over(rows: int, steps: int = 700) -> int:
    """Passes that make ``steps`` batches at least, but 2 to 20."""
    return min(20, max(2, -(-steps // max(1, rows // BATCH))))


@dataclass
class Texts:
    """Per text, the table rows of each word, made when asked for: ``rows`` has those of the distinct words,
    ``places`` the words of all texts, which end at ``ends``."""

    rows: np.ndarray
    places: np.ndarray
    ends: np.ndarray  # from 0

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, k: int) -> np.ndarray:
        return self.rows[self.places[self.ends[k] : self.ends[k + 1]]]

    def met(self) -> np.ndarray:
        """The table rows of all words, in order."""
        return np.unique(self.rows[np.unique(self.places)])


def train(net: Network, samples: list[np.ndarray] | Texts, labels: np.ndarray, passes: int, seed: int = 7,
          rate: float = 0.02) -> Network:
    """Fit ``net`` in place by Adam on the logistic loss, one batch of texts at a time.

    The loss's slope reaches only the words where a filter has its maximum.
    """
    rng = np.random.default_rng(seed)
    dense = [*net.filters, net.bias, net.weights, net.offset]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in [*dense, net.table]]
    step = 0
    n_batches = max(1, len(samples) // BATCH)
    for _ in range(passes):
        for batch in np.array_split(rng.permutation(len(samples)), n_batches):
            grads = [np.zeros_like(p) for p in dense]
            rows: list[np.ndarray] = []
            slopes: list[np.ndarray] = []
            for k in batch:
                ids = samples[k]
                vectors = net.table.take(ids, axis=0).sum(axis=1)
                pooled, at = net.maxima(vectors)
                active = np.maximum(pooled, 0)
                z = active @ net.weights + net.offset[0]
                error = 1 / (1 + np.exp(-z)) - labels[k]
                grads[-2] += error * active
                grads[-1] += error
                back = error * net.weights * (pooled > 0)
                grads[-3] += back
                for w, f in enumerate(net.filters):
                    here, slope = at[w * FILTERS : (w + 1) * FILTERS], back[w * FILTERS : (w + 1) * FILTERS]
                    for j in range(len(f)):
                        grads[w][j] += vectors[here + j].T * slope
                        rows.append(ids[here + j].ravel())
                        slopes.append(np.repeat((f[j] * slope).T, ids.shape[1], axis=0))
            step += 1
            touched, place = np.unique(np.concatenate(rows), return_inverse=True)
            table_grad = np.zeros((len(touched), DIM), np.float32)
            np.add.at(table_grad, place, np.concatenate(slopes))
            correct = (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for p, g, (m, v) in zip(dense, grads, state):
                g = g / len(batch)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * correct * m / (np.sqrt(v) + 1e-8)
            # Rows of the table move only when a text touches them.
            m, v = state[-1]
            g = table_grad / len(batch) + DECAY * net.table[touched]
            m[touched] += 0.1 * (g - m[touched])
            v[touched] += 0.001 * (g * g - v[touched])
            net.table[touched] -= rate * correct * m[touched] / (np.sqrt(v[touched]) + 1e-8)
            net.table[-1] = 0
    return net


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as fold 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5, F.lit(4))


@dataclass
class Classifier:
    net: Network
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5


def best_thresholds(scored: DataFrame, min_toxic: int, piece_rows: int = SPLIT_ROWS) -> tuple[float, dict[str, float]]:
    """The threshold of all rows of (lang, score, toxic), and those of languages with ``min_toxic``
    toxic rows: the middle of the gap between scores that gives the fewest errors, or 0.5; on a tie the
    one closest to 0.5, then the lowest.

    Every score counts: they are sorted across tasks, and running counts of a range start from the
    counts of the ranges before. Only a row per language comes back.
    """
    spark = scored.sparkSession
    # Every row counts for all, which the empty name stands for, and for its language if it has one.
    own = F.when(F.col("lang") != "", F.array(F.lit(""), "lang")).otherwise(F.array(F.lit("")))
    points = staged(
        scored.select("score", "toxic", F.explode(own).alias("of")).groupBy("of", "score").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")),
        "calibration-scores",
    )
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), points.count() // piece_rows + 1)
    points = staged(
        points.repartitionByRange(pieces, "of", "score").withColumn("piece", F.spark_partition_id()),
        "calibration-ranges",
    )
    # One row per range and language reaches these windows.
    ranges = Window.partitionBy("of").orderBy("piece")
    starts = points.groupBy("of", "piece").agg(
        F.sum("bad").alias("b"), F.sum("good").alias("g"), F.min("score").alias("low")
    ).select(
        "of", "piece", (F.sum("b").over(ranges) - F.col("b")).alias("bad_before"),
        (F.sum("g").over(ranges) - F.col("g")).alias("good_before"), F.lead("low").over(ranges).alias("next_low"),
        F.sum("b").over(Window.partitionBy("of")).alias("all_bad"),
        F.sum("g").over(Window.partitionBy("of")).alias("all_good"),
    )
    inside = Window.partitionBy("of", "piece").orderBy("score")
    cut = (F.coalesce(F.lead("score").over(inside), F.col("next_low")) + F.col("score")) / 2
    # Where no double lies between two scores, the middle is the lower one, which it then flags.
    flagged = cut <= F.col("score")
    missed = F.col("bad_before") + F.sum("bad").over(inside) - F.when(flagged, F.col("bad")).otherwise(0)
    passed = F.col("good_before") + F.sum("good").over(inside) - F.when(flagged, F.col("good")).otherwise(0)
    gaps = points.join(starts, ["of", "piece"]).select(
        "of", cut.alias("cut"), (missed + F.col("all_good") - passed).alias("errors")
    ).where(F.col("cut").isNotNull())
    below = F.col("score") < 0.5
    middle = points.groupBy("of").agg(F.sum(F.when(below, F.col("bad")).otherwise(F.col("good"))).alias("errors"))
    best = gaps.unionByName(middle.withColumn("cut", F.lit(0.5))).groupBy("of").agg(
        F.min(F.struct("errors", F.abs(F.col("cut") - 0.5).alias("off"), "cut")).alias("best")
    )
    toxic = points.groupBy("of").agg(F.sum("bad").alias("toxic"))
    found = {r["of"]: r for r in best.join(toxic, "of").select("of", "best.cut", "toxic").collect()}
    common = found.pop("", None)
    return (
        common.cut if common else 0.5,
        {of: r.cut for of, r in sorted(found.items()) if r.toxic >= min_toxic},
    )


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang, toxic and whether the row calibrates, of each document with a label whose
    fold is not 0. An id labelled twice counts once, with its larger label."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & (fold("doc_id") != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    known = staged(known, "known-labels")
    known = F.broadcast(known) if is_small(known, LABEL_ROWS) else known
    return texts_of(docs, "doc_id", "text", "lang").join(known, "doc_id").select(
        "doc_id", "text", "lang", "toxic", (fold("doc_id") == 1).alias("calibrates")
    )


def fit(docs: DataFrame, labels: DataFrame, min_toxic: int = 20, shard_rows: int = SHARD_ROWS) -> Classifier:
    """Train on every labelled row whose fold is not 0; fold 1 only calibrates thresholds.

    A language gets a threshold of its own if it has ``min_toxic`` calibration rows of
    label 1, else the common one holds. Rows without label or without document teach nothing.
    """
    prepared(docs.sparkSession)
    rows = staged(labelled(docs, labels), "labelled-texts")
    lessons = rows.where(~F.col("calibrates"))
    n = lessons.count()
    if not n:
        lessons, n = rows, rows.count()
    net = train_in_shards(lessons, n, shard_rows)
    scored = with_score(rows.where("calibrates").select("lang", "text", "toxic"), "text", Classifier(net), "score")
    threshold, thresholds = best_thresholds(scored.drop("text"), min_toxic)
    return Classifier(net, thresholds, threshold)


def train_in_shards(rows: DataFrame, n: int, shard_rows: int = SHARD_ROWS) -> Network:
    """A network from all ``n`` rows, in shards of about ``shard_rows`` rows.

    In each round every shard goes on from the common network. Then dense parameters are the mean over
    shards, and a row of the table is the mean over the shards that met one of its words.
    """
    spark, net = rows.sparkSession, Network.fresh(7)
    shards = -(-n // shard_rows)
    passes = passes_over(n // max(shards, 1))
    rounds = min(ROUNDS, shards)
    dealt = rows.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(shards, 1))).cast("int").alias("shard"), "doc_id", "text", "toxic"
    )
    # Texts move and are cut into words once; every round reads the stored shards.
    dealt = staged(dealt.groupBy("shard").applyInArrow(shard_words, SHARD_SQL), "training-shards")
    for turn in range(rounds):
        start = spark.sparkContext.broadcast(net)
        now = passes // rounds + (turn < passes % rounds)
        parts = dealt.mapInArrow(each_shard(lesson(start, now, turn)), PARTS_SQL)
        for r in parts.groupBy("piece").applyInArrow(mean_parts, PARTS_SQL).collect():
            vectors = np.frombuffer(r.vectors, np.float32)
            if r.piece < 0:
                net = net.with_dense(vectors)
            else:
                net.table[np.frombuffer(r.places, np.int32)] = vectors.reshape(-1, DIM)
        start.unpersist()
    return net


PARTS_SQL = "shard int, piece int, places binary, vectors binary"
PARTS = pa.schema([("shard", pa.int32()), ("piece", pa.int32()), ("places", pa.binary()), ("vectors", pa.binary())])


SHARD_SQL = "shard int, truth binary, sizes binary, places binary, rows binary"
SHARD = pa.schema([("shard", pa.int32()), *((n, pa.binary()) for n in ("truth", "sizes", "places", "rows"))])


def shard_words(table):
    """A shard's texts as one row: labels, numbers of words, the places of the words among the distinct
    ones, and the table rows of these. Words are distinct among ``WORDS_OF`` texts, so that no task holds
    those of a whole shard as objects."""
    order = pc.sort_indices(table, [(c, "ascending") for c in ("doc_id", "text", "toxic")])
    sizes, places, words, n = [], [], [], 0
    for a in range(0, len(order), WORDS_OF):
        texts = table.column("text").take(order[a : a + WORDS_OF]).cast(pa.binary()).to_pylist()
        index, rows = words_at(texts)
        sizes += map(len, index)
        # The last row is that of no word, which padding names.
        places.append(np.concatenate(index) % len(rows) + n)
        words.append(rows)
        n += len(rows)
    packed = {
        "truth": table.column("toxic").take(order).to_numpy().astype(np.float32),
        "sizes": np.array(sizes, np.int64),
        "places": np.concatenate(places).astype(np.int32),
        "rows": np.concatenate(words),
    }
    return pa.Table.from_arrays([table.column("shard")[:1].cast(pa.int32()).combine_chunks(), *map(one_value, packed.values())], schema=SHARD)


def one_value(x: np.ndarray) -> pa.Array:
    """The bytes of an array as a column of one row, without a copy."""
    ends = np.array([0, x.nbytes], np.int32)
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def each_shard(work):
    """``work`` on each stored shard, as a table with a row per text; the table rows of its distinct
    words go along as ``rows`` of the metadata."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in SHARD.names}
                ends = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"].as_buffer(), np.int64))])
                truth = np.frombuffer(row["truth"].as_buffer(), np.float32)
                places = pa.LargeListArray.from_arrays(ends, np.frombuffer(row["places"].as_buffer(), np.int32))
                shard = np.full(len(truth), row["shard"].as_py())
                texts = pa.table({"shard": shard, "toxic": truth, "places": places})
                yield from work(texts.replace_schema_metadata({"rows": row["rows"].as_py()})).to_batches()

    return run


def lesson(start: Broadcast, passes: int, turn: int):
    """What a shard's rows make of the common network: its dense parameters and the rows they met."""

    def learn(table):
        shard = table.column("shard")[0].as_py()
        words = np.frombuffer(table.schema.metadata[b"rows"], np.int32).reshape(-1, 1 + len(PREFIXES))
        places = table.column("places").combine_chunks()
        # Rows are looked up text by text: those of a whole shard at once are several times its words.
        samples = Texts(words, places.values.to_numpy(), places.offsets.to_numpy())
        net = train(start.value.copy(), samples, table.column("toxic").to_numpy(), passes, seed=7 + 1000 * shard + turn)
        met = samples.met()
        parts = [(-1, b"", net.dense())]
        for piece in np.unique(met // PIECE):
            at = met[met // PIECE == piece]
            parts.append((int(piece), at.tobytes(), net.table[at]))
        return pa.Table.from_pylist(
            [{"shard": shard, "piece": p, "places": at, "vectors": v.tobytes()} for p, at, v in parts], PARTS
        )

    return learn


def mean_parts(table):
    """The mean of a piece over shards; of the table's rows, over the shards that met them."""
    parts = sorted(table.to_pylist(), key=lambda r: r["shard"])
    piece = parts[0]["piece"]
    if piece < 0:
        mean = np.mean([np.frombuffer(r["vectors"], np.float32) for r in parts], axis=0, dtype=np.float64)
        places = b""
    else:
        total, met = np.zeros((PIECE, DIM)), np.zeros((PIECE, 1))
        for r in parts:
            at = np.frombuffer(r["places"], np.int32) - piece * PIECE
            total[at] += np.frombuffer(r["vectors"], np.float32).reshape(-1, DIM)
            met[at] += 1
        at = np.flatnonzero(met)
        mean, places = total[at] / met[at], (at + piece * PIECE).astype(np.int32).tobytes()
    return pa.Table.from_pylist(
        [{"shard": -1, "piece": piece, "places": places, "vectors": mean.astype(np.float32).tobytes()}], PARTS
    )


def with_score(docs: DataFrame, text: str, model: Classifier, column: str) -> DataFrame:
    """``docs`` with the probability that a text is toxic, from its words alone.

    A null or empty text gets the score of no words. Any other column passes through untouched.
    """
    fields = [(f.name, f.dataType.simpleString()) for f in docs.schema if f.name != column]
    net = docs.sparkSession.sparkContext.broadcast(model.net)

    def work(batches):
        words = WordVectors(net.value.table)
        for batch in batches:
            logits = np.array([net.value.logit(words.of(t or b"")) for t in byte_texts(batch, text)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n, _ in fields),
                 pa.array(1 / (1 + np.exp(-logits)), pa.float64())],
                [*(n for n, _ in fields), column],
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in [*fields, (column, "double")])
    return docs.mapInArrow(work, schema)


def toxic_scores(docs: DataFrame, labels: DataFrame, model: Classifier | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted (score of 0.5 or more), threshold of the document's
    language, flagged (score at or above it), for each row of ``docs``.

    The score reads nothing but the text. Null and unknown languages take the common threshold.
    """
    model = model or fit(docs, labels)
    scored = with_score(texts_of(docs, "doc_id", "text", "lang"), "text", model, "score")
    return scored.select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        threshold_of("lang", model).alias("threshold"),
        (F.col("score") >= threshold_of("lang", model)).alias("flagged"),
    )


def threshold_of(lang: str, model: Classifier) -> Column:
    out = F.lit(float(model.threshold))
    for name, value in sorted(model.thresholds.items()):
        out = F.when(F.col(lang) == name, F.lit(value)).otherwise(out)
    return out

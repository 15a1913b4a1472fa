"""Quality rules: counts of each text, and documents depleted by lines their host repeats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideledger.llm.text import byte_texts, lists, prepared, signed, texts_of
from tideledger.operators.staging import staged

MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = b"#*$%&|<>"
# A line is above the limits if more documents of its host hold it than this share and this number.
HOST_SHARE = 0.1
HOST_DOCS = 10
LEFT_SHARE = 0.5


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    pairs = np.unique(codes[:-1] * len(numbers) + codes[1:], return_inverse=True)[1]
    windows = pairs[:n] * len(numbers) + codes[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    found = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[place] > 1)
    found[starts] += 1
    found[starts + WINDOW] -= 1
    return int((np.cumsum(found)[:-1] > 0).sum())


def line_facts(text: bytes) -> tuple[int, list[bytes], list[int]]:
    """Lines equal to an earlier one, and the normalised lines with their words; lines without
    words are left out."""
    seen: set[bytes] = set()
    again, lines, sizes = 0, [], []
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        again += line in seen
        seen.add(line)
        lines.append(b" ".join(words).lower())
        sizes.append(len(words))
    return again, lines, sizes


def measured(docs: DataFrame) -> DataFrame:
    """The counts of ``docs(doc_id, text, host)``, with a hash and the words of each line."""

    def work(batches):
        for batch in batches:
            counts, sizes, keys, words_of_lines = [], [], [], []
            for text in byte_texts(batch, "text"):
                words = text.split()
                # Bytes that go on with a character are 0x80 to 0xBF.
                joined = b"".join(words)
                chars = len(joined.decode("utf-8", "surrogatepass"))
                again, lines, line_words = line_facts(text)
                symbols = len(text) - len(text.translate(None, SYMBOLS))
                counts.append((len(words), chars, symbols, again, repeated_words(words)))
                sizes.append(len(lines))
                keys += map(xxhash.xxh3_64_intdigest, lines)
                words_of_lines += line_words
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *columns,
                 lists(signed(np.array(keys, np.uint64)), np.array(sizes), pa.int64()),
                 lists(np.array(words_of_lines, np.int64), np.array(sizes), pa.int64())],
                ["doc_id", "host", *COUNTS, "keys", "line_words"],
            )

    return docs.mapInArrow(
        (lambda batches: work(b for b in batches if b.num_rows)),
        "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", keys array<long>, line_words array<long>",
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host: str = "source",
    host_share: float = HOST_SHARE,
    host_docs: int = HOST_DOCS,
    left_share: float = LEFT_SHARE,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    words_left: one row for each row of ``docs``.

    A document fails the base rules with fewer than 50 words or if more than half of its words lie
    in windows of three words that the text repeats. Otherwise each of its lines is looked up, in
    lower case and with single blanks, among its host's documents: lines held by more than
    ``host_share`` of them and by ``host_docs`` at least are removed, and the document is rejected
    if fewer than ``left_share`` of its words are left. Null and empty texts have no words and fail.
    Null hosts form one host; repeated rows are documents of their own.

    A host's removed lines are a short list (mean lines of a document over ``host_share`` at most);
    only line hashes are shuffled, a document counting once for a line.
    """
    prepared(docs.sparkSession)
    texts = texts_of(docs.withColumnsRenamed({}), id_col, text_col, host).withColumnRenamed(host, "host")
    facts = staged(measured(texts), "measured")
    hosts = facts.groupBy("host").agg(F.count("*").alias("n_host")).withColumnRenamed("host", "of_host")
    frequent = (
        facts.select("host", F.explode(F.array_distinct("keys")).alias("key"))
        .groupBy("host", "key")
        .agg(F.count("*").alias("n_docs"))
        .where(F.col("n_docs") >= host_docs)
        .join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
        .where(F.col("n_docs") > host_share * F.col("n_host"))
        .groupBy("of_host")
        .agg(F.collect_list("key").alias("removed"))
    )
    frequent = staged(frequent, "frequent")
    judged = facts.join(frequent, F.col("host").eqNullSafe(F.col("of_host")), "left")
    gone = F.aggregate(
        F.zip_with(
            "keys", "line_words",
            lambda key, words: F.when(F.array_contains("removed", key), words).otherwise(F.lit(0)),
        ),
        F.lit(0).cast("long"),
        lambda total, words: total + words,
    )
    judged = judged.withColumn(
        "words_left",
        F.col("n_words") - F.when(F.col("removed").isNull(), F.lit(0)).otherwise(gone),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    )
    return judged.select(
        "doc_id", *COUNTS, "base_failed",
        (~F.col("base_failed") & (F.col("words_left") >= left_share * F.col("n_words"))).alias("kept"),
        "words_left",
    )

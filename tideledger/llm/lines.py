"""Lines that many pages of a host share, found and dropped with SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger.llm.text import prepared
from tideledger.operators.staging import staged

SPACE = "[\\x20\\x09-\\x0D]+"
# Hashes that order the lines of a page.
MARKS = (11, 23, 47)
RATIO = 0.05
MIN_PAGES = 5


def normalised(line: Column) -> Column:
    """Lower case, runs of ASCII white space as one blank, none at the ends."""
    return F.trim(F.lower(F.regexp_replace(line, SPACE, " ")))


def line_keys(text: Column) -> Column:
    """A hash for each line, in order; null for a line without a word."""
    return F.transform(
        F.split(text, "\n", -1),
        lambda line: F.when(normalised(line) != "", F.xxhash64(normalised(line))),
    )


def near_copy_marks(keys: Column) -> Column:
    """The two smallest lines of a page under each of three hashes: what a page is known by where one
    of its lines is looked at is the smallest of the others. Pages that share most of their lines
    agree in that mostly, pages that share only boilerplate seldom."""

    lines = F.filter(F.array_distinct(keys), lambda k: k.isNotNull())

    def two_smallest(seed: int) -> Column:
        return F.slice(F.sort_array(F.transform(lines, lambda k: F.xxhash64(k, F.lit(seed)))), 1, 2)

    return F.array(*[two_smallest(seed) for seed in MARKS])


def page_counts(pages: DataFrame, near_copies_once: bool = False) -> DataFrame:
    """Pages per host and line from ``pages(host, keys)``: host, key, n_pages, n_host.

    With ``near_copies_once`` pages of a line count once if they agree in a mark
    (``near_copy_marks``); of the counts under the three hashes the middle one is taken.
    """
    marks = []
    if near_copies_once:
        # Before the lines are dealt out: a page's marks are made once, not once a line.
        pages = pages.withColumn("marks", near_copy_marks(F.col("keys")))
        marks = ["marks"]
    lines = pages.select("host", *marks, F.explode(F.array_distinct("keys")).alias("key")).where(
        F.col("key").isNotNull()
    )
    if near_copies_once:
        others = [
            F.struct(
                F.lit(i).alias("i"),
                F.when(F.col("marks")[i][0] == F.xxhash64("key", F.lit(seed)), F.get(F.col("marks")[i], F.lit(1)))
                .otherwise(F.col("marks")[i][0]).alias("mark"),
            )
            for i, seed in enumerate(MARKS)
        ]
        # One row per line and mark first, so that no set of marks grows with the pages of a line.
        lines = (
            lines.select("host", "key", F.explode(F.array(*others)).alias("other"))
            .distinct()
            .groupBy("host", "key", "other.i").agg(F.count("*").alias("n"))
            .groupBy("host", "key").agg(F.array_sort(F.collect_list("n"))[1].alias("n_pages"))
        )
    else:
        lines = lines.groupBy("host", "key").agg(F.count("*").alias("n_pages"))
    hosts = pages.groupBy("host").agg(F.count("*").alias("n_host"))
    return lines.where(F.col("n_pages") > 1).join(
        hosts.withColumnRenamed("host", "of_host"), F.col("host").eqNullSafe(F.col("of_host"))
    ).drop("of_host")


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    copies_once: bool = False,
) -> DataFrame:
    """``docs`` with two more columns: n_lines and clean_text, the text without boilerplate.

    A line is boilerplate on a host if more than ``ratio`` of the host's pages hold it, and
    ``min_pages`` of them at least. Every row is a page, repeated rows too; with ``copies_once``
    pages of a host with the same lines are one page, and pages that agree in a mark
    (``near_copy_marks``) count once for a line, so that a content is not boilerplate because it has
    copies or near copies. An empty table gives an empty result. A line counts once for a page. Lines are compared in normalised form and kept as they were written. Lines without a
    word are never counted and always stay. Rows without a host form a host of their own. A null
    text has no lines (n_lines 0) and stays null; a text whose lines all go becomes empty. Other
    columns are left alone.

    Each host's boilerplate is one short list: no more lines can pass the ratio than the mean
    number of lines of a page divided by it. Only line hashes are shuffled.
    """
    prepared(docs.sparkSession)
    keyed = docs.select(F.col(host).cast("string").alias("host"), line_keys(F.col(text)).alias("keys"))
    if copies_once:
        keyed = keyed.withColumn("content", F.xxhash64("keys")).dropDuplicates(["host", "content"]).drop("content")
    frequent = (
        page_counts(keyed, copies_once)
        .where((F.col("n_pages") > ratio * F.col("n_host")) & (F.col("n_pages") >= min_pages))
        .groupBy("host")
        .agg(F.collect_list("key").alias("__boilerplate"))
        .withColumnRenamed("host", "__host")
    )
    frequent = staged(frequent, "boilerplate")
    joined = docs.join(
        frequent, F.col(host).cast("string").eqNullSafe(F.col("__host")), "left"
    )
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(
        lines,
        lambda line: (normalised(line) == "")
        | ~F.array_contains(F.col("__boilerplate"), F.xxhash64(normalised(line))),
    )
    return joined.select(
        *(docs[c] for c in docs.columns if c not in ("n_lines", "clean_text")),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("__boilerplate").isNull(), F.col(text))
        .otherwise(F.array_join(kept, "\n"))
        .alias("clean_text"),
    )

"""CSV files of any size, read in splits: records with quoted line breaks, and content ids.

Spark's text source hands out lines, each split of a file to one task. Whether a line begins inside a
quoted field depends on everything before it, but only through one bit. So a first pass notes, per
split, the bit at its end for either bit at its start, and a running pass over these few rows gives the
bit at the start of every split. A second pass then cuts each split into records on its own; what
crosses a border is put together from the pieces of the splits it touches.

The first pass also makes the id of a file: a polynomial over the SHA-256 of its lines. Such sums of
two parts combine to that of the whole, so the id does not depend on where splits fall.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideledger.operators.staging import staged

# Modulus and base of the polynomial.
PRIME = 2**255 - 19
BASE = 0x6C62272E07BB014262B821756295C58D1B3F5A7D9E4C2A60F18D35B7A92C4E01
QUOTED_END = re.compile(rb'[^"]*(?:""[^"]*)*"(?!")')
SUMMARY = ("file long, block long, lines long, digest binary, first binary, "
           "after_outside boolean, after_inside boolean")
RECORD = "file long, block long, part int, record string"
WHOLE, HEAD, TAIL = 0, 1, 2


def text_lines(df: DataFrame) -> DataFrame:
    """file (a number), block (where the split starts), value of each line of a text reader's frame,
    in the reader's order."""
    return df.select(
        F.xxhash64(file_name()).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def file_name():
    """The base name of a row's file; the metadata path is URL-encoded but for plus signs."""
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def inside_after(line: bytes, inside: bool) -> bool:
    """Whether the line after this one begins inside a quoted field. A quote opens a field only at its
    start; a doubled quote is a character; text after a closing quote runs to the delimiter."""
    if b'"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            end = QUOTED_END.match(line, at)
            if not end:
                return True
            at = line.find(b",", end.end())
            if at < 0:
                return False
            at += 1
        if line[at : at + 1] == b'"':
            inside, at = True, at + 1
            continue
        at = line.find(b',"', at)
        if at < 0:
            return False
        inside, at = True, at + 2


def joined(digest_a: int, digest_b: int, lines_b: int) -> int:
    """The digest of two runs of lines, one after the other."""
    return (digest_a * pow(BASE, lines_b, PRIME) + digest_b) % PRIME


def line_digest(line: bytes) -> int:
    return int.from_bytes(hashlib.sha256(line).digest())


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Consecutive lines of one split within a batch, in the reader's order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "block"))
        values = batch.column("value").to_pylist()
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(values)]):
            yield int(file[a]), int(block[a]), values[a:b]


def split_summaries(lines: DataFrame) -> DataFrame:
    """One row per split: number of lines, digest, first line, and where a quoted field is open."""

    def row(key, n, digest, first, outside, inside) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "file": pa.array([key[0]], pa.int64()), "block": pa.array([key[1]], pa.int64()),
            "lines": pa.array([n], pa.int64()), "digest": pa.array([digest.to_bytes(32)], pa.binary()),
            "first": pa.array([first], pa.binary()),
            "after_outside": pa.array([outside]), "after_inside": pa.array([inside]),
        })

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for file, block, values in runs(batches):
            if key != (file, block):
                if key:
                    yield row(key, *state)
                key, state = (file, block), (0, 0, values[0], False, True)
            n, digest, first, outside, inside = state
            for line in values:
                digest = (digest * BASE + line_digest(line)) % PRIME
                if b'"' in line:
                    outside, inside = inside_after(line, outside), inside_after(line, inside)
            state = n + len(values), digest, first, outside, inside
        if key:
            yield row(key, *state)

    return lines.mapInArrow(work, SUMMARY)


def file_summaries(splits: DataFrame) -> DataFrame:
    """file, lines, digest (hexadecimal), header (the first line) and the blocks that begin inside a
    quoted field. A file's splits are few: some 100 bytes for each 128 MB."""
    whole = splits.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct(
            "block", "lines", "digest", "first", "after_outside", "after_inside"
        ))).alias("splits")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, parts in zip(batch.column("file").to_pylist(), batch.column("splits").to_pylist()):
                n, digest, inside, open_at = 0, 0, False, []
                for p in parts:
                    if inside:
                        open_at.append(p["block"])
                    digest = joined(digest, int.from_bytes(p["digest"]), p["lines"])
                    n += p["lines"]
                    inside = p["after_inside"] if inside else p["after_outside"]
                header = parts[0]["first"].decode("utf-8", "replace").strip("﻿\r")
                out.append((file, n, digest.to_bytes(32).hex(), header, open_at))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["file", "lines", "digest", "header", "open_at"],
            )

    return whole.mapInArrow(
        work, "file long, lines long, digest string, header string, open_at array<long>"
    )


def cut_records(lines: DataFrame, open_blocks: list[tuple[int, int]]) -> DataFrame:
    """The records of each split without each file's header and blank lines, and the pieces of those
    that cross a border: HEAD ends (or goes on) where a split begins, TAIL begins where one ends.

    ``open_blocks`` are the (file, block) of splits that begin inside a quoted field: rare, and one
    per split at most. A header must not hold line breaks.
    """
    began_inside = frozenset(open_blocks)

    def batch_of(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        file, block, part, record = zip(*rows)
        text = [r.decode("utf-8", "replace").removesuffix("\r") for r in record]
        return pa.RecordBatch.from_arrays(
            [pa.array(file, pa.int64()), pa.array(block, pa.int64()), pa.array(part, pa.int32()), pa.array(text)],
            ["file", "block", "part", "record"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, held, kind = None, False, [], WHOLE
        for file, block, values in runs(batches):
            rows = []
            if key != (file, block):
                if held:
                    rows.append((*key, HEAD if kind == HEAD else TAIL, b"\n".join(held)))
                key, held = (file, block), []
                inside = key in began_inside
                kind = HEAD if inside else WHOLE
                if block == 0:
                    values = values[1:]
            for line in values:
                held.append(line)
                inside = inside_after(line, inside)
                if inside:
                    continue
                if kind == HEAD or len(held) > 1 or line.strip():
                    rows.append((*key, kind, b"\n".join(held)))
                held, kind = [], WHOLE
            if rows:
                yield batch_of(rows)
        if held:
            yield batch_of([(*key, HEAD if kind == HEAD else TAIL, b"\n".join(held))])

    return lines.mapInArrow(work, RECORD)


def assembled(pieces: DataFrame) -> DataFrame:
    """file and record of the records that cross borders, from their pieces."""
    in_file = Window.partitionBy("file").orderBy("block", "part")
    chain = F.sum((F.col("part") == TAIL).cast("int")).over(in_file)
    # Two pieces per split at most reach this window.
    return (
        pieces.withColumn("chain", chain)
        .groupBy("file", "chain")
        .agg(F.array_sort(F.collect_list(F.struct("block", "record"))).alias("p"))
        .select("file", F.array_join("p.record", "\n").alias("record"))
    )


def parsed(lines: DataFrame, open_blocks: list[tuple[int, int]], width: int) -> DataFrame:
    """file and the fields c0, c1, ... of every record as text, from one pass over the lines.

    Fields beyond a record's own are NULL, as are empty ones without quotes.
    """
    names = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in names)

    def fields(record):
        return F.from_csv(record, schema, {"escape": '"', "multiLine": "true"})

    cut = cut_records(lines, open_blocks)
    whole = F.col("part") == WHOLE
    stored = staged(
        cut.select(
            "file", "block", "part", F.when(~whole, F.col("record")).alias("record"),
            F.when(whole, fields(F.col("record"))).alias("fields"),
        ),
        "csv-records",
    )
    crossing = assembled(stored.where(~whole)).select("file", fields(F.col("record")).alias("fields"))
    return stored.where(whole).select("file", "fields.*").unionByName(crossing.select("file", "fields.*"))

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideledger.llm import queries, sharding
from tideledger.llm.sharding import Permutation, number_at, shard_and_slot, sharded, write_shards

DOCS = "doc_id long, text string, shard int, slot string, row_number long"


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 63, 64, 65, 1000, 4099])
def test_permutation_is_a_bijection_with_an_inverse(n):
    numbers = np.arange(n)
    places = Permutation(n).places(numbers)
    assert sorted(places) == list(range(n))
    assert (Permutation(n).numbers(places) == numbers).all()
    if n > 60:
        assert (places != Permutation(n, seed=5).places(numbers)).any()
        assert np.abs(np.corrcoef(numbers, places)[0, 1]) < 0.3


def test_permutation_of_numbers_beyond_32_bits():
    n = 10**13 + 7
    numbers = np.random.default_rng(1).integers(0, n, 10_000)
    places = Permutation(n).places(numbers)
    assert places.min() >= 0 and places.max() < n
    assert (Permutation(n).numbers(places) == numbers).all()
    assert np.bincount(places % 8, minlength=8).min() > 1000


def odd_docs(spark, copies=300):
    rows = [(i, f"text {i % 40} é", None, "x", 5) for i in range(200)]
    rows += [(None, None, 1, None, None), (None, "", 2, "s", 0), (-4, "word " * 50_000, 3, "s", 1)]
    # A third and more of all rows is one row.
    rows += [(7, "copy", 0, "s", 0)] * copies
    return spark.createDataFrame(rows, DOCS)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=repr)


def test_shards_are_even_gapless_and_computable(spark):
    docs = odd_docs(spark)
    got = sharded(docs).collect()
    n = docs.count()
    assert len(got) == n
    counts = [sum(r.shard == s for r in got) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32))
    assert sorted(r.row_number for r in got) == list(range(n))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.row_number)] == [r.doc_id for r in order]
    numbers = np.array([r.row_number for r in got])
    shard, slot = shard_and_slot(numbers, n)
    assert shard.tolist() == [r.shard for r in got] and slot.tolist() == [r.slot for r in got]
    assert (number_at(shard, slot, n) == numbers).all()
    texts = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
             for i, t in docs.select("doc_id", "text").collect()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == texts


def test_shards_do_not_depend_on_partitions(spark):
    docs = odd_docs(spark)
    want = shown(sharded(docs))
    assert shown(sharded(docs.repartition(13, F.rand(3)))) == want
    assert shown(sharded(docs.coalesce(1).orderBy(F.desc("text")))) == want
    assert shown(sharded(docs, seed=9)) != want


def test_few_rows_and_none(spark):
    docs = odd_docs(spark, 0)
    assert sharded(docs.limit(0)).count() == 0
    three = sharded(docs.where("doc_id BETWEEN 3 AND 5")).collect()
    assert len({r.shard for r in three}) == 3 and {r.slot for r in three} == {0}


def test_written_shards_hold_every_row_in_slot_order(spark, tmp_path):
    docs = odd_docs(spark, 30)
    stored = write_shards(docs, str(tmp_path / "out"), file_rows=10)
    assert stored.count() == docs.count()
    files = sorted((tmp_path / "out").glob("shard=*/*.parquet"))
    assert {p.parent.name for p in files} == {f"shard={s}" for s in range(8)}
    for p in files:
        slots = [r.slot for r in spark.read.parquet(str(p)).collect()]
        assert slots == list(range(slots[0], slots[0] + len(slots))) and len(slots) <= 10
    kept = sorted((tuple(r) for r in stored.select("doc_id", "text", "shard_", "slot_", "row_number_").collect()), key=repr)
    assert kept == sorted((tuple(r) for r in docs.collect()), key=repr)


def test_query_gives_one_law(spark, tmp_path):
    odd_docs(spark).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_sharding(spark, str(tmp_path))
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert sharding.SHARDS == 8

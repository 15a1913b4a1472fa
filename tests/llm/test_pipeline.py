import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__
from tests.llm.test_operators import brute_components, docs, edited, prose
from tideledger.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_registered(spark):
    assert {*queries.queries(), "pipeline"} <= {*__spark_entry__.queries()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-dedup", "secrets", "packing"]


def test_pipeline_packs_what_the_stages_keep(spark):
    whole = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = whole
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, FOLDER)
        assert kept.columns == whole.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert all(i == root for i, (_, root) in brute_components(texts, 5, 80).items())
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in packed} == {*texts}
    assert sum(r.size for r in packed) == sum(len(t.encode().split()) for t in texts.values())


def test_near_copies_leave_one_of_each_group(spark):
    base = prose(3, 200)
    rows = docs(spark, (1, base), (2, base), (3, edited(base, 1, 2)), (4, prose(8, 90)), (5, ""), (6, None))
    out = corpus_pipeline.without_near_copies(spark, rows, FOLDER)
    assert sorted(r.doc_id for r in out.collect()) == [1, 4, 5, 6]
    # Rows are dropped, not ids: a copy without an id goes, another text under a copy's id stays.
    more = rows.union(docs(spark, (None, base), (2, prose(9, 80)), (None, prose(10, 80)), (4, prose(8, 90))))
    out = corpus_pipeline.without_near_copies(spark, more.withColumn("__row", F.lit(1)), FOLDER)
    assert out.columns == [*rows.columns, "__row"]
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(1, base), (2, prose(9, 80)), (4, prose(8, 90)), (5, ""), (6, None),
                          (None, prose(10, 80))], key=repr)
    assert corpus_pipeline.without_near_copies(spark, rows.limit(0), FOLDER).count() == 0


def test_near_copies_are_no_boilerplate(spark):
    shared, foot = [prose(40 + i, 14, 3000) for i in range(9)], "all rights reserved"
    rows = [(i, "\n".join([prose(300 + i, 14, 3000), *shared])) for i in range(12)]
    rows += [(100 + i, "\n".join([*(prose(900 + 7 * i + n, 14, 3000) for n in range(4)), foot])) for i in range(88)]
    lean = corpus_pipeline.without_boilerplate(spark, docs(spark, *rows), FOLDER)
    out = {r.doc_id: r.text for r in corpus_pipeline.without_near_copies(spark, lean, FOLDER).collect()}
    kept = [t for i, t in out.items() if i < 100]
    assert len(kept) == 1 and all(line in kept[0] for line in shared)
    assert all(foot not in out[100 + i] for i in range(88)) and len(out) == 89


def test_one_of_a_group_of_copies_keeps_its_text(spark):
    copied, foot = prose(5, 60) + "\n" + prose(6, 60), "about this site"
    rows = [(i, copied.upper() if i % 2 else copied) for i in range(20)]
    rows += [(100 + i, prose(700 + i, 80, 4_000) + "\n" + foot) for i in range(30)]
    lean = corpus_pipeline.without_boilerplate(spark, docs(spark, *rows), FOLDER)
    out = {r.doc_id: r.text for r in corpus_pipeline.without_near_copies(spark, lean, FOLDER).collect()}
    assert [i for i in out if i < 100] == [0] and out[0] == copied
    assert {*out} == {0, *range(100, 130)}
    assert all(foot not in out[100 + i] and out[100 + i] for i in range(30))

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_ingest_and_operations import KOREAN, ORDERS, SHIPMENTS, box, put, status  # noqa: F401
from tideledger.operators.staging import staged
from tideledger.sources import inbox as source
from tideledger.sources.csv_splits import inside_after, parsed, split_summaries


@contextmanager
def splits_of(spark, size):
    """Files are cut every ``size`` bytes, and each piece goes to a task of its own."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": str(size)}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def read_split(spark, folder, width):
    files, lines = source.list_files(spark, str(folder)), source.lines_of(spark, str(folder))
    found = staged(source.identified(files, lines), "found")
    open_blocks = [tuple(r) for r in found.select("file", F.explode("open_at")).collect()]
    cells = parsed(lines, open_blocks, width).join(found, "file")
    return found, cells.select("file_name", *[f"c{i}" for i in range(width)]), open_blocks


def some_file(seed, n):
    """CSV text with quoted line breaks, doubled quotes, stray quotes, empty fields and blank lines."""
    rng = random.Random(seed)
    fields = ['plain', '', '""', '"a, b"', '"line\nbreak"', '"two\n\nbreaks, and ""quotes"""', '5" pipe',
              '"x" tail', "주문", '"' + "long\n" * 40 + '"', " spaced ", '"ends in quote"""']
    body = [",".join(rng.choice(fields) for _ in range(3)) for _ in range(n)]
    body.insert(n // 2, "")
    return "h1,h2,h3\n" + "\n".join(body) + ("\n" if seed % 2 else "")


@pytest.mark.parametrize("size", [50, 333, 10_000_000])
def test_rows_equal_those_of_whole_files(spark, tmp_path, size):
    for seed in range(3):
        (tmp_path / f"f{seed}.csv").write_text(some_file(seed, 60), encoding="utf-8")
    whole = spark.read.schema("c0 string, c1 string, c2 string").csv(
        str(tmp_path), header=True, multiLine=True, escape='"', pathGlobFilter="*.csv", enforceSchema=True
    ).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file_name"), "*")
    want = rows(whole, *whole.columns)
    with splits_of(spark, size):
        found, cells, open_blocks = read_split(spark, tmp_path, 3)
        assert rows(cells, *cells.columns) == want and len(want) == 180
        tasks = source.lines_of(spark, str(tmp_path)).rdd.getNumPartitions()
        assert (tasks > 50 and len(open_blocks) > 20) if size == 50 else tasks >= 1


def test_ids_follow_the_bytes_and_not_the_splits(spark, tmp_path):
    text = some_file(1, 80)
    same = {"a": text, "b": text}
    head, *body = text.split("\n")
    at = next(i for i, (a, b) in enumerate(zip(body, body[1:])) if a != b)
    body[at], body[at + 1] = body[at + 1], body[at]
    other = {"end": text[:-1], "char": text.replace("plain", "plaim", 1), "break": text + "\n",
             "order": "\n".join([head, *body])}
    for name, content in {**same, **other}.items():
        (tmp_path / f"{name}.csv").write_text(content, encoding="utf-8")

    def ids():
        found = source.identified(source.list_files(spark, str(tmp_path)), source.lines_of(spark, str(tmp_path)))
        return {r.file_name.split(".")[0]: r.file_hash for r in found.collect()}

    with splits_of(spark, 70):
        small = ids()
        summary = split_summaries(source.lines_of(spark, str(tmp_path)))
        assert summary.count() > 100
    with splits_of(spark, 100_000_000):
        assert ids() == small
    assert small["a"] == small["b"]
    assert len(set(small.values())) == len(small) - 1


def test_carriage_returns_and_byte_order_marks(spark, tmp_path):
    content = "﻿h1,h2\r\n1,\"a\r\nb\"\r\n2,c\r\n"
    (tmp_path / "w.csv").write_bytes(content.encode("utf-8"))
    (tmp_path / "bad.csv").write_bytes(b"h1,h2\n1,\xff\xfe\n")
    found, cells, _ = read_split(spark, tmp_path, 2)
    assert {r.header for r in found.collect()} == {"h1,h2"}
    assert rows(cells.where("file_name = 'w.csv'"), "c0", "c1") == [("1", "a\r\nb"), ("2", "c")]
    assert cells.where("file_name = 'bad.csv'").count() == 1


@pytest.mark.parametrize("line,outside,inside", [
    (b"a,b", False, True), (b'a,"b', True, False), (b'"a",b', False, False), (b'a"b,c', False, False),
    (b'x","y', True, True), (b'"a""', True, False), (b'""', False, True), (b'a,""', False, True),
    (b'5" pipe,"open', True, True),
])
def test_open_fields(line, outside, inside):
    assert inside_after(line, False) == outside
    assert inside_after(line, True) == inside


def test_a_quoted_file_of_many_splits_is_loaded(box):  # noqa: F811
    wh, folder = box
    body = "".join(f'OMS,"ORD-{i}",1,2024-01-15,"STORE\nA",SKU-{i % 7},{i % 9 + 1}\n' for i in range(300))
    put(folder, a=ORDERS.splitlines()[0] + "\n" + body, z=ORDERS.splitlines()[0])
    with splits_of(wh.spark, 400):
        out = source.ingest(wh, str(folder), 1)
        assert status(out) == {"a.csv": "success", "z.csv": "skipped"}
        assert {r.row_count for r in out.collect()} == {300, 0}
    assert wh.order.count() == 300
    assert rows(wh.order.select("channel_store_id").distinct(), "channel_store_id") == [("STORE\nA",)]


def test_stream_loads_each_file_once_and_resumes(box, tmp_path):  # noqa: F811
    wh, folder = box
    ids = iter(range(1, 100))
    checkpoint = str(tmp_path / "log")
    run = lambda **k: source.ingest_stream(wh, str(folder), checkpoint, lambda: next(ids), **k)
    put(folder, a=ORDERS)
    run()
    assert wh.order.count() == 2 and wh.file_log().count() == 1
    run()
    assert wh.file_log().count() == 1
    put(folder, b=KOREAN, c=SHIPMENTS, d=ORDERS)

    # The run dies after it has written facts, before it has logged the files.
    append = wh.append

    def dies(layer, table, frame):
        if table == "system_file_log":
            raise RuntimeError("lost")
        append(layer, table, frame)

    wh.append = dies
    with pytest.raises(Exception, match="lost"):
        run(files_per_batch=3)
    wh.append = append
    assert wh.order.count() == 3
    run(files_per_batch=3)
    assert wh.order.count() == 3 and wh.shipment.count() == 1
    log = {r.file_name: r.status for r in wh.file_log().collect()}
    assert log == {"a.csv": "success", "b.csv": "success", "c.csv": "success", "d.csv": "skipped"}
    run()
    assert wh.file_log().count() == 4

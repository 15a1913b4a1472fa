import numpy as np
import pytest

from tideledger.llm import hardnegatives as hard
from tideledger.llm.hardnegatives import Rules, bounds, hard_negatives, hilbert_keys

VECTORS = "vec_id long, embedding array<double>, label int, block string, dim string, score double, n int"


def brute(rows, rules, scale=256):
    fine = [(i, np.floor(scale * np.array(v, float)).astype(int), y) for i, v, y in rows
            if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v, y) in enumerate(fine):
        if i % rules.every:
            continue
        scored = [(-int(v @ w), j, z) for b, (j, w, z) in enumerate(fine) if b != a and len(w) == len(v)]
        same = sorted(s for s in scored if s[2] == y)[: rules.positives]
        for minus, j, _ in same:
            hits = sorted(s for s in scored if s[2] != y and rules.low * -minus <= 100 * -s[0] <= rules.high * -minus)
            out += [(i, j, r + 1, k, -minus, -m) for r, (m, k, _) in enumerate(hits[: rules.negatives])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "d", 0.5, 1) for r in rows], VECTORS)


def result(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def clusters(rng, n, dim, centres, spread):
    at = rng.normal(size=(centres, dim))
    which = rng.integers(0, centres, n)
    data = at[which] + spread * rng.normal(size=(n, dim))
    # Each label takes two neighbouring clusters, and some rows are labelled by chance.
    label = np.where(rng.random(n) < 0.2, rng.integers(0, 4, n), which % 4)
    return [(int(i), data[i].tolist(), int(label[i])) for i in range(n)]


@pytest.mark.parametrize("spread,block", [(0.05, 16), (1.0, 7), (0.3, 500)])
def test_equals_brute_force(spark, monkeypatch, spread, block):
    monkeypatch.setattr(hard, "GROUP_ANCHORS", 8)
    monkeypatch.setattr(hard, "ZONES_AT_ONCE", 4)
    rows = clusters(np.random.default_rng(4), 300, 5, 6, spread)
    # A vector that a third of all rows share, null and broken ones, another length, repeated rows.
    rows += [(1000 + i, rows[0][1], int(i % 3)) for i in range(150)]
    rows += [(20, None, 1), (40, rows[1][1], None), (None, rows[1][1], 1), (60, [], 1),
             (80, [None] * 5, 2), (120, [float("nan")] * 5, 2), (140, [float("inf")] * 5, 1),
             (2000, [0.5, 0.5], 1), (2001, [0.4, 0.5], 1), (2002, [0.45, 0.5], 2), (160, [0.0] * 5, 1),
             rows[10], rows[20]]
    rules = Rules(every=20, positives=3, negatives=4)
    got = hard_negatives(frame(spark, rows).repartition(5), rules=rules, block_rows=block)
    want = brute(rows, rules)
    assert result(got) == want and len(want) > 50


def test_zone_maps_leave_most_blocks_unread(spark):
    rows = clusters(np.random.default_rng(5), 600, 6, 8, 0.02)
    rules = Rules(every=50)
    df = frame(spark, rows).selectExpr("vec_id", "cast(label as long) label",
                                       "transform(embedding, x -> floor(256 * x)) vector")
    blocks = hard.ordered_blocks(df, 20)
    anchors = hard.anchors_of(blocks, rules)
    asks = hard.asked(blocks, anchors, rules, hard.wants_positives)
    reads = asks.selectExpr("sum(size(members)) n").first().n
    assert reads < 0.25 * blocks.count() * anchors.count()
    with_positives = hard.positives(blocks, anchors, rules)
    asks = hard.asked(blocks, with_positives, rules, hard.wants_negatives)
    reads = asks.selectExpr("sum(size(members)) n").first().n
    assert reads < 0.5 * blocks.count() * anchors.count()


def test_no_anchor_no_positive_and_empty_table(spark):
    rows = [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]
    assert result(hard_negatives(frame(spark, rows))) == []
    assert result(hard_negatives(frame(spark, [(100, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]))) == []
    assert result(hard_negatives(frame(spark, rows).limit(0))) == []
    # Windows of negative positives hold nothing.
    below = [(100, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.9, 0.0], 2)]
    assert result(hard_negatives(frame(spark, below))) == [] == brute(below, Rules())


def test_scores_that_may_leave_64_bits_are_refused(spark):
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives(frame(spark, [(100, [1e12, 1.0], 1), (2, [1.0, 1.0], 1)]))


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(2)
    anchors, points = rng.integers(-9, 9, (5, 3)), rng.integers(-9, 9, (40, 3))
    lo, hi = points.min(axis=0)[None], points.max(axis=0)[None]
    least, most = bounds(anchors, lo, hi)
    scores = anchors @ points.T
    assert (scores >= least).all() and (scores <= most).all()
    least, most = bounds(anchors, points, points)
    assert (least == scores).all() and (most == scores).all()


@pytest.mark.parametrize("dim,bits", [(2, 3), (3, 2), (2, 4)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dim, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dim, indexing="ij"), -1).reshape(-1, dim)
    keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    along = cells[np.array(sorted(range(len(cells)), key=keys.__getitem__))]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()

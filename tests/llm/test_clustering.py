import hashlib

import numpy as np
import pytest

from tideledger.llm import clustering
from tideledger.llm.clustering import cluster_report, clustered, encode

VECTORS = "vec_id long, embedding array<float>, cluster string, distance string, vector int"


def brute(vectors, dim, k, rounds):
    """vec_id, cluster, distance and the centroids by plain integer arithmetic."""
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in vectors
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [list(v) for _, v in starts[:k]]

    def assign():
        out = []
        for _, v in kept:
            gaps = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((gaps.index(min(gaps)), min(gaps)))
        return out

    for _ in range(rounds):
        chosen = [c for c, _ in assign()]
        for c in range(len(centroids)):
            own = [v for (_, v), d in zip(kept, chosen) if d == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    return sorted(((i, c, d) for (i, _), (c, d) in zip(kept, assign())), key=repr), centroids


def odd_vectors(rng, n, dim, values=None):
    rows = []
    for i in range(n):
        v = rng.normal(size=dim) if values is None else rng.choice(values, size=dim)
        rows.append((i, [float(x) for x in v]))
    rows += [(3, rows[5][1]), (None, rows[7][1]), (900, None), (901, [1.0] * (dim - 1)), (902, []),
             (903, [None] + [0.0] * (dim - 1)), (904, [float("nan")] * dim),
             (905, [float("-inf")] + [0.0] * (dim - 1)), (906, [0.0] * dim)]
    # One vector holds a third of all rows.
    return rows + [(1000 + i, rows[0][1]) for i in range(n // 2)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "d", 1) for i, v in rows], VECTORS)


@pytest.mark.parametrize("values", [None, [0.0, 0.5, -0.25]])
def test_equals_plain_k_means(spark, values, monkeypatch):
    monkeypatch.setattr(clustering, "PAGE_ROWS", 16)
    vectors = odd_vectors(np.random.default_rng(3), 60, 6, values)
    assigned, centroids = clustered(frame(spark, vectors).repartition(3), dim=6, k=4, rounds=5)
    want, plain = brute(vectors, 6, 4, 5)
    assert centroids.tolist() == plain
    got = assigned.collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=repr) == want
    report = cluster_report(assigned, centroids).collect()
    assert len(report) == len(want)
    for r in report:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in want)
        joined = ",".join(map(str, plain[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    # Equal starts: the second centroid never wins a tie and keeps its place.
    vectors = [(i, [1.0, 2.0]) for i in range(9)] + [(9, [-3.0, 0.0009])]
    assigned, centroids = clustered(frame(spark, vectors), dim=2, k=3, rounds=3)
    want, plain = brute(vectors, 2, 3, 3)
    assert sorted(tuple(r) for r in assigned.collect()) == want and centroids.tolist() == plain


def test_no_vectors_and_fewer_than_centroids(spark):
    none, centroids = clustered(frame(spark, [(1, None), (2, [1.0])]), dim=2)
    assert none.count() == 0 and len(centroids) == 0
    assert cluster_report(none, centroids).count() == 0
    two, centroids = clustered(frame(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])]), dim=2)
    assert len(centroids) == 2 and {r.distance for r in two.collect()} == {0}


def test_huge_components_are_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        clustered(frame(spark, [(1, [1e30, 1.0]), (2, [1.0, 1.0])]), dim=2)


def test_dictionaries_lose_nothing_and_find_their_width():
    rng = np.random.default_rng(1)
    plain = rng.integers(-500, 500, (400, 20))
    few = np.repeat(rng.integers(-500, 500, (5, 20)), 80, axis=0)
    mixed = np.concatenate([few[:, :8], plain[:, 8:]], axis=1)
    for rows, widths in [(plain, [1] * 20), (few, [8, 8, 4]), (mixed, [8] + [1] * 12)]:
        got, entries, codes = encode(rows)
        assert got == widths
        assert (np.concatenate([e[c] for e, c in zip(entries, codes)], axis=1) == rows).all()

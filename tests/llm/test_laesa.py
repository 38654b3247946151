import hashlib
import math
import random

import numpy as np
import pytest

from sieveline.llm import laesa

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, rounds, dim, scale=64):
    """Plain form: [(id, cluster, distance)], centroids; rows are (id, vector)."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if len(v) == dim]
    order = sorted(kept, key=lambda row: hashlib.sha256(f"1:{row[0]}".encode()).hexdigest())
    centroids = [v for _, v in order[:k]]

    def assign():
        found = []
        for i, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            found.append((i, far.index(min(far)), min(far)))
        return found

    for _ in range(rounds):
        where = [cluster for _, cluster, _ in assign()]
        for c in range(len(centroids)):
            members = [v for (_, v), at in zip(kept, where) if at == c]
            if members:
                centroids[c] = [sum(part) // len(members) for part in zip(*members)]
    return assign(), centroids


def some_vectors(n, dim, clusters, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, dim)) * 3
    vectors = centers[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * 0.2
    return [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(vectors)]


def test_as_brute_force(spark):
    rows = some_vectors(400, 8, 9)
    found = laesa.cluster(spark.createDataFrame(rows, SCHEMA).repartition(5), k=7, rounds=3, dim=8, n_pivots=4).collect()
    expected, centroids = brute(rows, 7, 3, 8)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found) == sorted(expected)
    total = sum(distance for _, _, distance in expected)
    for row in found:
        assert row.inertia == total and row.cluster_inertia == sum(d for _, c, d in expected if c == row.cluster)
        assert row.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[row.cluster])).encode()).hexdigest()
    # Clustered data: the bounds leave few centroids.
    assert sum(row.n_exact for row in found) < 0.5 * 7 * len(found)


def test_bounds_lose_nothing():
    rng = np.random.default_rng(1)
    rows, centroids = rng.integers(-9, 9, (300, 3)), rng.integers(-9, 9, (20, 3))
    pivots = laesa.far_apart(rows, 5)
    cluster, distance, _ = laesa.closest(rows, laesa._roots(rows, pivots), centroids, laesa._roots(centroids, pivots))
    far = ((rows[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_edges(spark):
    good = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [-0.5, 0.01]), (None, [1.0, 1.0])]
    bad = [(5, None), (6, []), (7, [1.0]), (8, [1.0, None]), (9, [float("nan"), 0.0]), (10, [float("inf"), 0.0])]
    rows = [(i, v, "x", 3) for i, v in good + bad]
    random.Random(2).shuffle(rows)
    # Columns with the names of the result are not read.
    given = spark.createDataFrame(rows, SCHEMA + ", cluster string, distance int")
    found = laesa.cluster(given, k=2, rounds=2, dim=2).collect()
    assert sorted(str(row.vec_id) for row in found) == ["1", "1", "1", "2", "None"]
    assert len({(row.cluster, row.distance) for row in found if row.vec_id == 1}) == 1
    # The two of least hash are the copies of one vector or differ; equal centroids: the smaller number wins.
    same = laesa.cluster(spark.createDataFrame([(1, [0.5, 0.5])] * 4, SCHEMA), k=3, rounds=3, dim=2).collect()
    assert [(row.cluster, row.distance, row.inertia) for row in same] == [(0, 0, 0)] * 4
    # Fewer vectors than centroids; no vector; no row.
    assert len(laesa.cluster(spark.createDataFrame(good[3:], SCHEMA), k=16, dim=2).collect()) == 2
    for none in (bad, []):
        empty = laesa.cluster(spark.createDataFrame(none, SCHEMA), dim=2)
        assert empty.collect() == [] and "centroid_sha256" in empty.columns


def test_components_that_are_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        laesa.cluster(spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA), dim=2).collect()

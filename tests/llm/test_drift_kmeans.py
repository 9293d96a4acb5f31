"""Centroid clustering against all distances of all rounds, and its defined cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import drift_kmeans
from tidemark.llm.drift_kmeans import assign, loosened, loosening, squared


def by_hand(rows, k, rounds, width):
    v = [(i, [math.floor(float(c) * 256) for c in x]) for i, x in rows if x is not None and len(x) == width and all(c is not None and math.isfinite(c) for c in x)]
    order = sorted(v, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in order[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        mine = [near(x)[1] for _, x in v]
        for n in range(len(centroids)):
            own = [x for (_, x), m in zip(v, mine) if m == n]
            if own:
                centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    return sorted(((i, near(x)[1], near(x)[0]) for i, x in v), key=str), centroids


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, "a", 0) for i, x in rows], "vec_id long, embedding array<float>, cluster string, distance int")


def clumps(rng, n, width, spread):
    middles = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i, [float(np.float32(m + rng.gauss(0, spread))) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 0.6])
def test_equals_all_distances(spark, spread):
    rng = random.Random(4)
    rows = clumps(rng, 300, 8, spread)
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (900, None), (901, [1.0] * 7), (902, [None] + [1.0] * 7), (903, [float("nan")] * 8), (904, [float("inf")] * 8), (905, [-0.001] * 8)]
    state, centroids = drift_kmeans.cluster(vectors(spark, rows), k=11, rounds=4, width=8)
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in state.collect()), key=str)
    want, middles = by_hand(rows, 11, 4, 8)
    assert got == want and centroids.tolist() == middles


def test_large_components_are_exact(spark):
    rng = random.Random(9)
    rows = [(i, [float(np.float32(rng.choice([1e6, 1e9, -1e9, 0.5]) + rng.random())) for _ in range(3)]) for i in range(40)]
    state, centroids = drift_kmeans.cluster(vectors(spark, rows), k=5, rounds=3, width=3)
    want, middles = by_hand(rows, 5, 3, 3)
    fits = lambda d: d if d < 2**63 else None
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in state.collect()), key=str) == sorted(((i, c, fits(d)) for i, c, d in want), key=str)
    assert centroids.tolist() == middles


def test_loosening_bounds_what_every_vector_of_a_sphere_loses():
    rng = np.random.default_rng(2)
    for width in (2, 3, 20):
        before = rng.normal(0, 5, (6, width))
        after = before + rng.normal(0, 1, (6, width)) * rng.integers(0, 2, (6, 1))
        radius = rng.uniform(0, 8, 6)
        each = loosening(before, after, radius)
        drift = np.sqrt(((after - before) ** 2).sum(1))
        assert (each <= drift[None, :] + 1e-12).all() and (each >= 0).all()
        for i in range(6):
            x = rng.normal(size=(4000, width))
            x *= (radius[i] * rng.random((4000, 1)) ** (1 / 3)) / np.sqrt((x * x).sum(1, keepdims=True))
            x = np.concatenate([x + before[i], before[i : i + 1]])
            for j in range(6):
                lost = np.sqrt(((x - before[j]) ** 2).sum(1)) - np.sqrt(((x - after[j]) ** 2).sum(1))
                assert lost.max() <= each[i, j] + 1e-9


def test_geometry_scans_fewer_vectors_than_whole_drift():
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(m, 6, (200, 16)) for m in rng.normal(0, 40, (12, 16))]).astype(np.int64)
    counts = {}
    for geometric in (True, False):
        centroids, n = v[rng.choice(len(v), 12, replace=False)] if not counts else start, 0
        start = centroids
        cluster, bound = np.full(len(v), -1), np.zeros(len(v))
        for _ in range(6):
            cluster, distance, bound, scanned = assign(v, cluster, bound, centroids)
            every = squared(v, centroids)
            assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
            n += scanned
            new = np.array([v[cluster == c].sum(0) // max(1, (cluster == c).sum()) if (cluster == c).any() else centroids[c] for c in range(12)])
            radius = np.array([np.sqrt(distance[cluster == c].max(initial=0)) for c in range(12)])
            if geometric:
                loose = loosened(centroids.astype(float), new.astype(float), radius)
            else:
                drift = np.sqrt(((new - centroids) ** 2).sum(1))
                loose = np.array([np.delete(drift, c).max() for c in range(12)])
            bound, centroids = bound - loose[cluster], new
        counts[geometric] = n
    assert counts[True] < counts[False] < 6 * len(v)


def test_ties_go_to_the_smaller_number():
    v, centroids = np.array([[0, 0], [5, 5], [1, 0]]), np.array([[1, 0], [-1, 0], [1, 0]])
    cluster, distance, bound, scanned = assign(v, np.array([1, 2, 2]), np.array([1.0, 0.0, 0.0]), centroids)
    assert cluster.tolist() == [0, 0, 0] and distance.tolist() == [1, 41, 0] and scanned == 3


def test_empty_tables_and_fewer_vectors_than_clusters(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        state, centroids = drift_kmeans.cluster(vectors(spark, rows), width=3)
        assert state.collect() == [] and len(centroids) == 0
    state, centroids = drift_kmeans.cluster(vectors(spark, [(1, [1.0, 2.0, 3.0]), (2, [3.0, 2.0, 1.0])]), width=3)
    assert sorted(r.distance for r in state.collect()) == [0, 0] and len(centroids) == 2

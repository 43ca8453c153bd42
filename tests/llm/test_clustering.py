"""Centroid clustering against plain Lloyd rounds in whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from smogmesh.llm import clustering

SCHEMA = "vec_id long, embedding array<double>, cluster string, at int"


def lloyd(rows, dims, k, rounds, salt="3"):
    """Every vector against every centroid in every round, with Python numbers."""
    kept = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    keyed = [(hashlib.sha256(f"{salt}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    c = [list(v) for _, v in sorted(keyed)[:k]]
    for t in range(rounds + 1):
        own = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, x)) for x in c]
            own.append(d.index(min(d)) if d else -1)
        if t == rounds or not c:
            break
        for j in range(len(c)):
            mine = [v for (_, v), a in zip(kept, own) if a == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    return [(i, a, sum((x - y) ** 2 for x, y in zip(v, c[a]))) for (i, v), a in zip(kept, own)] if c else [], c


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def random_rows(dims, n, seed=3):
    r = np.random.default_rng(seed)
    heart = r.normal(size=(5, dims))
    return [(i, [float(x) for x in heart[i % 5] + 0.3 * r.normal(size=dims)]) for i in range(n)]


def odd_rows(dims):
    v = [0.25] * dims
    return [
        (900, None), (901, []), (902, v[:-1]), (903, v + [1.0]), (904, [None] * dims), (905, [float("nan")] * dims),
        (906, [float("inf")] + v[1:]), (907, v), (907, v), (None, v), (None, [-0.3] * dims), (908, [-1e-20] * dims),
    ]


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 0), (1, 4), (30, 6)])
def test_equals_plain_rounds(spark, k, rounds):
    rows = random_rows(6, 300) + odd_rows(6)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(5)
    got, centroids, _ = clustering.clusters(df, dims=6, k=k, rounds=rounds)
    want, c = lloyd(rows, 6, k, rounds)
    assert order(map(tuple, got.collect())) == order(want)
    assert centroids == c


def test_ties_go_to_the_smaller_centroid(spark):
    # A grid of whole numbers: many vectors are equally far from two centroids.
    rows = [(i, [(i % 7) / 1024, (i // 7 % 7) / 1024]) for i in range(98)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got, _, _ = clustering.clusters(df, dims=2, k=5, rounds=6)
    assert order(map(tuple, got.collect())) == order(lloyd(rows, 2, 5, 6)[0])


def test_wide_components_stay_exact(spark):
    rows = [(i, [float(3 ** (i % 40)) * (-1) ** i, 2.0**60 + i]) for i in range(60)] + [(90, [1e200, -1e200])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got, centroids, _ = clustering.clusters(df, dims=2, k=4, rounds=5)
    want, c = lloyd(rows, 2, 4, 5)
    assert centroids == c
    assert order(map(tuple, got.collect())) == order((i, a, d if d < 2**63 else None) for i, a, d in want)


def test_bounds_spare_evaluations(spark):
    rows = random_rows(16, 600)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    _, _, work = clustering.clusters(df, dims=16, k=8, rounds=10)
    assert work[0] == 600 * 8
    assert sum(work[1:]) < 0.7 * 600 * 8 * len(work[1:])


def test_total_displacement_is_tighter_than_summed_moves():
    # A centroid that comes back has no displacement, however far it travelled.
    history = [[[0, 0], [100, 0]], [[50, 0], [100, 0]], [[0, 0], [100, 0]]]
    assert clustering.Bounds(history).moved[0].tolist() == [0.0, 0.0]


def test_inertia_and_digest(spark):
    rows = random_rows(4, 80)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got, centroids, _ = clustering.clusters(df, dims=4, k=3, rounds=3)
    want, c = lloyd(rows, 4, 3, 3)
    for r in clustering.with_inertia(got, centroids).collect():
        assert r["cluster_inertia"] == sum(d for _, a, d in want if a == r["cluster"])
        assert r["inertia"] == sum(d for _, _, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[r["cluster"]])).encode()).hexdigest()


def test_empty_and_unusable_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got, centroids, work = clustering.clusters(empty)
    assert (got.count(), centroids, work) == (0, [], [])
    assert clustering.with_inertia(got, centroids).count() == 0
    null_keys = spark.createDataFrame([(None, [1.0, 2.0], "x", 1)], SCHEMA)
    assert clustering.clusters(null_keys, dims=2)[0].count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0], "x", 1)], SCHEMA)
    assert [tuple(r) for r in clustering.clusters(one, dims=2)[0].collect()] == [(1, 0, 0)]

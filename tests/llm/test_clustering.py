import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from remitflow.llm.clustering import centroid_clusters, nearest, products, updated

SCHEMA = "vec_id long, embedding array<double>, cluster string, d int, k int"


def brute(rows, centroids, rounds, components=64, seed=1):
    """Everything anew in each round, with Python integers."""
    kept = [(i, [math.floor(Fraction(x) * 64) for x in e]) for i, e in rows
            if e is not None and len(e) == components and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:centroids]]

    def far(v, c):
        return sum((a - b) ** 2 for a, b in zip(v, c))

    def assign():
        return [min(range(len(cents)), key=lambda k: (far(v, cents[k]), k)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for k in range(len(cents)):
            own = [v for (_, v), a in zip(kept, at) if a == k]
            if own:
                cents[k] = [sum(c) // len(own) for c in zip(*own)]
    at = assign()
    d = [far(v, cents[a]) for (_, v), a in zip(kept, at)]
    by = {k: sum(x for x, a in zip(d, at) if a == k) for k in set(at)}

    def fits(x):
        return x if x < 1 << 63 else None

    return sorted(((i, a, fits(x), fits(by[a]), fits(sum(d)), hashlib.sha256(",".join(map(str, cents[a])).encode()).hexdigest())
                   for (i, _), a, x in zip(kept, at, d)), key=str)


def run(spark, rows, centroids=4, rounds=3, components=64):
    df = spark.createDataFrame([(i, e, "x", 1, 2) for i, e in rows], SCHEMA)
    return sorted((tuple(r) for r in centroid_clusters(df, components, centroids, rounds).collect()), key=str)


def vectors(n, seed, size=64):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, size))
    return [(i, (middle[i % 5] + rng.normal(size=size) * 0.4).tolist()) for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_equals_brute_force(spark, rounds):
    rows = vectors(90, rounds)
    assert run(spark, rows, rounds=rounds) == brute(rows, 4, rounds)


def test_odd_rows_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [None, 1.0]), (None, [0.5, 0.5]), (10, [-0.001, 0.001])] + [(20 + i, [0.0, 0.0]) for i in range(30)]
    for centroids in (1, 2, 5, 100):
        assert run(spark, rows, centroids, components=2) == brute(rows, centroids, 3, components=2)


def test_integers_beyond_64_bits(spark):
    rows = [(1, [1e300, -1.0]), (2, [1e300, 5.0]), (3, [-1.7e308, 0.0]), (4, [3e17, 1.0]), (5, [1.0, 2.0]), (6, [2.0, 1.0]), (7, [1e8, 0.25])]
    assert run(spark, rows, 3, components=2) == brute(rows, 3, 3, components=2)
    assert any(r[2] is None for r in brute(rows, 3, 3, components=2))


def test_no_vector_at_all(spark):
    df = spark.createDataFrame([(1, None, "x", 1, 2)], SCHEMA)
    out = centroid_clusters(df)
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroid_clusters(df.where("false")).collect() == []


def test_single_precision_input(spark):
    df = spark.createDataFrame([(i, e) for i, e in vectors(40, 9)], "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted((tuple(r) for r in centroid_clusters(df, centroids=3).collect()), key=str) == brute(rows, 3, 3)


def test_update_reads_moved_components_only():
    rng = np.random.default_rng(3)
    v, before = rng.integers(-90, 90, (50, 8)), rng.integers(-90, 90, (4, 8))
    after = before.copy()
    after[1, [2, 5]] += 7
    after[3, 0] -= 11
    dots = products(v, before)
    blind = v.copy()
    blind[:, [1, 3, 4, 6, 7]] = 0  # components in which no centroid moved
    assert (updated(dots, blind, before, after) == products(v, after)).all()
    norms = (after ** 2).sum(axis=1)
    assert (nearest(dots, before) == [min(range(4), key=lambda k: (((x - before[k]) ** 2).sum(), k)) for x in v]).all() and len(norms) == 4

import hashlib
import math
import random

import numpy as np
import pytest

from vanescope.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, id long, cluster int, distance string"


def expected(rows, k=8, rounds=10, size=4):
    kept = [
        (i, [math.floor(1024 * x) if abs(x) < 1e300 else int(x) * 1024 for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    own = [v for _, v in order[:k]]
    if not own:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(own)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(own)):
            members = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if members:
                own[j] = [sum(x) // len(members) for x in zip(*members)]
    near = assign()

    def fit(x):
        return x if x < 1 << 63 else None

    whole = fit(sum(d for d, _ in near))
    inertia = [fit(sum(d for d, c in near if c == j)) for j in range(len(own))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in own]
    return sorted(((i, c, fit(d), inertia[c], whole, digest[c]) for (i, _), (d, c) in zip(kept, near)), key=repr)


def found(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA).repartition(parts)
    got = centroids.cluster(df, size=4, **how)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def around(pick, n, centres=6, spread=0.3):
    middle = [[pick.uniform(-2, 2) for _ in range(4)] for _ in range(centres)]
    return [(i, [c + pick.gauss(0, spread) for c in pick.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 1, 10])
def test_equals_brute_force(spark, rounds):
    rows = around(random.Random(1), 400)
    assert found(spark, rows, rounds=rounds) == expected(rows, rounds=rounds)


def test_fewer_vectors_than_centroids_and_rest(spark):
    rows = around(random.Random(2), 5)
    assert found(spark, rows) == expected(rows)
    # All alike: every centroid but the first stays empty, and nothing ever moves.
    rows = [(i, [0.5, -0.5, 0.0, 1.0]) for i in range(50)]
    assert found(spark, rows) == expected(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *around(random.Random(3), 40), (100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0, None, 2.0, 3.0]), (104, [nan, 1.0, 1.0, 1.0]),
        (105, [inf, 1.0, 1.0, 1.0]), (7, [9.0, 9.0, 9.0, 9.0]), (7, [9.0, 9.0, 9.0, 9.0]), (None, [1.0, 1.0, 1.0, 1.0]), (None, None), (106, [-0.0, 0.0, -1e-9, 1e-9]),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []
    assert found(spark, [(None, [1.0, 1.0, 1.0, 1.0]), (1, None)]) == []


@pytest.mark.parametrize("large", [3e4, 1e7, 2.5e12, 1e18, 1e40, 1.5e308])
def test_large_components_stay_exact(spark, large):
    pick = random.Random(4)
    rows = [(i, [x * (large if i % 3 == 0 else 1) for x in v]) for i, v in around(pick, 60)]
    rows = [(i, [min(max(x, -1.7e308), 1.7e308) for x in v]) for i, v in rows]
    assert found(spark, rows) == expected(rows)


def test_only_moved_components_are_multiplied():
    vectors = np.arange(12, dtype=np.int16).reshape(3, 4)
    before = np.array([[1, 2, 3, 4], [5, 6, 7, 8]])
    after = np.array([[1, 2, 3, 4], [5, 9, 7, 8]])
    (j, change), = centroids.dot_changes(vectors, before, after)
    assert j == 1 and change.tolist() == (vectors[:, 1].astype(int) * 3).tolist()


def test_digits_add_up_to_the_number():
    for value in (0, 1, -1, 2**32, -(2**32), 2**32 - 1, -(2**40) - 17, 10**50, -(10**50)):
        assert sum(d << 32 * i for i, d in enumerate(centroids.digits(value))) == value
        assert all(0 <= d < 1 << 32 for d in centroids.digits(value)[:-1])

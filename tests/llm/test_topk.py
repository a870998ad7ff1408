import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanescope.llm import topk


def expected(rows, k):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault((i, tuple(math.floor(64 * x) for x in v)))
    out = []
    for i, v in whole:
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i and len(w) == len(v))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id long, score int")
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.exact_top_k(df, F.col("vec_id") % 20 == 0, k).collect())


@pytest.mark.parametrize("spread", [0.2, 0.02])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", 500)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 16)
    monkeypatch.setattr(topk, "BLOCKS_PER_TASK", 2)
    random = np.random.default_rng(8)
    centres = random.normal(0, 1, (12, 8))
    vectors = (centres[random.integers(0, 12, 1500)] + random.normal(0, spread, (1500, 8))).astype(np.float32)
    vectors[100:200] = vectors[100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    assert found(spark, rows) == expected(rows, 20)


def test_awkward_rows(spark):
    rows = [
        (0, [0.5, -0.5]), (1, [0.1, 0.2]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
        (6, [1.0, 1.0]), (6, [1.0, 1.0]), (7, [1.0, 1.0]), (20, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, []), (60, [-1.0, 0.0]), (8, [0.0, 0.0]),
    ]
    assert found(spark, rows) == expected(rows, 20)
    assert found(spark, []) == []


def test_large_components_stay_exact():
    ids = np.arange(200)
    x = np.random.default_rng(9).integers(-(10**6), 10**6, (200, 50))
    row, found_, score = topk.best(ids, x, ids[:3], x[:3], 5)
    for q in range(3):
        want = sorted((-int(x[q] @ x[j]), j) for j in range(200) if j != q)[:5]
        assert [(-s, i) for s, i in zip(score[row == q].tolist(), found_[row == q].tolist())] == want

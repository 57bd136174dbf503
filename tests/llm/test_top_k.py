import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import nra
from millrace.llm.queries import QUERIES

from .cases import MORE


def brute(rows, k, divisor=2):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * 1024) for x in v):
            return None
        return [math.floor(x * 1024) for x in v]

    fine = [(i, w) for i, v in rows if (w := whole(v)) is not None]
    out = []
    for a, (i, q) in enumerate(fine):
        if i is None or i % divisor:
            continue
        scores = [(max(min(sum(x * y for x, y in zip(q, v)), 2**63 - 1), -(2**63)), j) for b, (j, v) in enumerate(fine) if b != a]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(i, rank, j, s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(map(str, out))


def found(spark, rows, k, divisor=2, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3).withColumns({c: F.lit(1) for c in ("score", "rank", "entry", "v")})
    got = nra.top_k(df, F.col("vec_id") % divisor == 0, k=k, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(str(tuple(r)) for r in got.collect())


def vectors(n, dims, seed, spread=1.0):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [c + pick.gauss(0, spread) for c in pick.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"values": 200, "asked": 7, "sample": 4, "together": 3}])
def test_equals_brute_force(spark, options):
    rows = vectors(150, 12, 1, 0.3)
    rows += rows[:20] + [(i, rows[3][1]) for i in range(200, 215)]  # copies under the same and other ids
    rows += [(None, rows[5][1]), (8, rows[6][1]), (301, [0.0] * 12)]
    assert found(spark, rows, 5, 6, **options) == brute(rows, 5, 6)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (2, []), (4, [1.0, None]), (6, [nan]), (8, [inf, 1.0]), (10, [1.0]), (12, [-1.0, 2.0, -0.0]), (13, [1e200, 3.0]), (14, [-1e200]),
            (15, [1e-200, 0.0]), (16, [3e15, 5.0, 7.0]), (17, [1e308]), (18, [0.5, 0.5]), (None, [2.0]), (20, [1e9, -1e9, 0.3]), (20, [1e9, -1e9, 0.3])]
    assert found(spark, rows, 4) == brute(rows, 4)
    assert found(spark, rows, 100, values=3, asked=2, sample=3) == brute(rows, 100)
    assert found(spark, [], 3) == []
    assert found(spark, [(0, [1.0])], 3) == []
    assert found(spark, [(0, [1.0])] * 3, 1) == ["(0, 1, 0, 1048576)"] * 3


def test_search_reads_less_than_all():
    """Outsiders go before lists are read to the end."""
    pick = np.random.default_rng(3)
    v = np.floor(pick.normal(size=(4000, 16)) * 100)
    q = np.floor(v[:5] * 1.1)
    own = np.zeros((5, 4000), bool)
    alive = nra.search(q, own, np.full(5, -np.inf), v, np.sort(v, axis=0), 3)
    scores = q @ v.T
    for row, keep in zip(scores, alive):
        assert keep[np.argsort(-row)[:3]].all() and keep.sum() < 2000


def test_bounds_hold():
    pick = np.random.default_rng(4)
    v, q = np.floor(pick.normal(size=(300, 6)) * 9), np.floor(pick.normal(size=(20, 6)) * 9)
    lists = np.sort(v, axis=0)
    for t in (1, 30, 150, 299):
        lower, upper = nra.bounds(q, v, lists[0], lists[-1], lists[t - 1], lists[300 - t])
        assert (lower <= q @ v.T).all() and (q @ v.T <= upper).all()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MORE}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(str(tuple(r)) for r in QUERIES["op12_exact_top_k"](spark, MORE).collect()) == brute(rows, 10, 100)

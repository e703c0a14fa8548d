import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from statforge.llm import topk

SCHEMA = "vec_id bigint, embedding array<double>, rank string, score string, stripe string"


def brute(rows, every, k, scale=64):
    whole = {i: [math.floor(scale * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in whole.items():
        if q % every == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in whole.items() if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(hits, 1)]
    return sorted(out)


def found(spark, rows, every=5, k=20):
    df = spark.createDataFrame([(i, v, "r", "s", "t") for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % every == 0, k).collect()))


def test_equals_brute_force_with_ties_and_bad_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 380)]  # many equal vectors
    rows += [(400, None), (405, [0.1, None] + [0.0] * 6), (410, [float("nan")] * 8), (415, [float("inf")] * 8), (None, [0.1] * 8), (420, [0.0] * 8)]
    assert found(spark, rows) == brute(rows, 5, 20)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e6 + i / 64, -3e5]) for i in range(30)] + [(100 + i, [2.0**20 + i, 1.0]) for i in range(4)]
    assert found(spark, rows, every=10) == brute(rows, 10, 20)


@pytest.mark.parametrize("huge", [1e6, 3e7, 5e36, 1e200])
def test_one_huge_row_among_the_pivots_of_many_blocks(huge):
    rng = np.random.default_rng(10)
    rows = np.floor(rng.normal(0, 1, (8 * topk.BLOCK, 4)) * 64)
    pivots = np.array([rows[0], [huge * 64, -huge * 32, 0, 0], rows[1]])
    best = [topk.Best(20) for _ in range(50)]
    query = (np.arange(50), rows[:50], topk.distances(rows[:50], pivots))
    for at in range(0, len(rows), topk.BLOCK):
        own = rows[at : at + topk.BLOCK]
        topk.search(query, (np.arange(at, at + len(own)), own, topk.distances(own, pivots)), best)
    for i, b in enumerate(best):
        scores = (rows @ rows[i]).astype("int64")
        order = [j for j in np.lexsort((np.arange(len(rows)), -scores)).tolist() if j != i][:20]
        assert b.ids.tolist() == order and b.scores.tolist() == scores[order].tolist()


def test_huge_row_in_a_table_of_many_blocks(spark):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(3000)] + [(3001, [5e37, -1e37, 0.0, 0.0]), (3002, [0.0] * 4)]
    df = spark.createDataFrame([(i, v, "r", "s", "t") for i, v in rows], SCHEMA).repartition(2)
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 300 == 0, 20, pivot_sample=4000).collect()))
    assert got == [(q, n, i, max(min(s, 2**63 - 1), -(2**63))) for q, n, i, s in brute(rows, 300, 20)]


def test_huge_query_meets_rows_of_zeros():
    best = [topk.Best(3)]
    topk.search((np.array([0]), np.array([[1e200]]), np.zeros((1, 0))), (np.array([1, 2]), np.zeros((2, 1)), np.zeros((2, 0))), best)
    assert (best[0].ids.tolist(), best[0].scores.tolist()) == ([1, 2], [0, 0])


def test_few_rows_short_vectors_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (5, [-1.0, 0.25, 9.0])]
    assert found(spark, rows) == brute(rows, 5, 20)
    assert found(spark, []) == []


def test_repeated_ids_count_once(spark):
    got = found(spark, [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [3.0])])
    assert got == [(0, 1, 1, 64 * 192)]


def test_bounds_spare_work():
    import numpy as np

    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(0, 1, (4000, 3)) * 64 + np.repeat(rng.integers(-40, 40, (40, 3)) * 64, 100, 0))
    pivots = topk.choose_pivots(rows, 8)
    seen = []

    class Counting(topk.Best):
        def offer(self, ids, scores):
            seen.append(len(ids))
            super().offer(ids, scores)

    block = (np.arange(4000), rows, topk.distances(rows, pivots))
    query = (np.array([0]), rows[:1], topk.distances(rows[:1], pivots))
    topk.search(query, block, [Counting(10)])
    assert sum(seen) < 4000

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from urndraw.llm import topk


def slow(rows, k):
    good = {}
    for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, [math.floor(64 * x) for x in v])
    out = []
    for q in good:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(512, 4096), (7, 30)])
def test_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=19) * rng.choice([0.1, 1, 3])).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 19) for i in range(300, 380)]  # ties
    rows += [(400, None), (420, []), (440, [None] * 19), (460, [float("nan")] * 19), (480, [float("inf")] * 19), (None, [1.0] * 19),
             (500, [1.0, 2.0]), (501, [2.0, 1.0]), (502, [-1.0, 1.0]), (520, rows[0][1]), (520, rows[0][1]), (540, [0.0] * 19)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, block int")
    got = topk.nearest(table, F.col("vec_id") % 20 == 0, 20, 64.0, *blocks).collect()
    assert sorted(tuple(r) for r in got) == slow(rows, 20)


def test_bounds_are_never_below_the_score():
    rng = np.random.default_rng(2)
    for scale in (1, 50, 1e6):
        a, b = np.floor(rng.normal(size=(60, 33)) * scale), np.floor(rng.normal(size=(9, 33)) * scale)
        rows, queries = topk.Segments(a), topk.Segments(b)
        for q in range(len(b)):
            for level in range(len(topk.LEVELS)):
                assert (rows.bounds(level, queries, q, np.arange(60)) >= a @ b[q]).all()


def test_large_components():
    rows = np.array([[2.0 ** 40, 1.0], [2.0 ** 40, 2.0]])
    assert topk.exact(rows, np.array([2.0 ** 20, 1.0])).tolist() == [2 ** 60 + 1, 2 ** 60 + 2]


def test_queries_are_searched_together():
    # the number of steps depends on the queries together, not on each
    rng = np.random.default_rng(4)
    values = np.floor(rng.normal(size=(20_000, 64)) * 8)
    queries = topk.Segments(values[::20])
    ids, asked = np.arange(20_000), np.arange(0, 20_000, 20)
    got = list(topk.search(ids, topk.Segments(values), asked, queries, np.full(1000, -(2 ** 63)), 20))
    assert len(got) == -(-1000 // topk.TOGETHER)
    for q, found, scores in got[:1]:
        for one in (0, 40, 2000):
            product = (values @ values[one]).astype(int)
            want = [i for i in np.lexsort((ids, -product)) if i != one][:20]
            assert found[q == one].tolist() == want and scores[q == one].tolist() == product[want].tolist()
    assert sum(len(found) for _, found, _ in got) == 20_000


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.nearest(empty, F.col("vec_id") % 20 == 0).count() == 0

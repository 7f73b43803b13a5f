from __future__ import annotations

import numpy as np
import pytest

from urndraw.llm import covertree


def points(rng, n, dim=16, groups=6):
    centres = rng.normal(size=(groups, dim))
    rows = centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.12, 0.3, 1.5], size=(n, 1))
    rows[: n // 10] = rows[n // 2: n // 2 + n // 10]  # equal vectors
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_tree_is_nested_and_covers(seed):
    tree = covertree.CoverTree(covertree.unit(points(np.random.default_rng(seed), 300)))
    assert sorted(tree.order) == list(range(300))
    for node in range(len(tree.start)):
        members = tree.order[tree.start[node]:tree.stop[node]]
        far = np.linalg.norm(tree.points[members] - tree.centres[node], axis=1)
        assert far.max() <= tree.radius[node] + 1e-7
        if tree.last[node]:
            children = np.arange(tree.first[node], tree.last[node])
            assert (tree.centres[children[0]] == tree.centres[node]).all()
            assert sorted(tree.members(children)) == sorted(members)
            assert tree.radius[children].max() < tree.radius[node]


@pytest.mark.parametrize("least", [0.5, 0.93, 0.99])
def test_dual_traversal_equals_all_pairs(least):
    rng = np.random.default_rng(9)
    a, b = covertree.unit(points(rng, 400)), covertree.unit(points(rng, 250))
    for x, y in ((a, a), (a, np.r_[b, a[:50]])):
        left = covertree.CoverTree(x)
        right = left if y is x else covertree.CoverTree(y)
        got = [(int(i), int(j)) for p, q in covertree.linked(left, right, least) for i, j in zip(p, q)]
        assert len(got) == len(set(got))
        assert set(got) == set(zip(*np.nonzero(x @ y.T >= least)))


def slow(rows, least=0.93):
    ids = {r[0]: min((str(x[2]) if x[2] is not None else "", x[1] or []) for x in rows if x[0] == r[0]) and [x for x in rows if x[0] == r[0]][0] for r in rows}
    out, group = {i: 0 for i in ids}, {i: i for i in ids}

    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for i in ids:
        for j in ids:
            (_, a, la), (_, b, lb) = ids[i], ids[j]
            if i != j and la is not None and la == lb and good(a) and good(b) and len(a) == len(b):
                if np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                    out[i] += 1
                    group = {k: min(group[i], group[j]) if g in (group[i], group[j]) else g for k, g in group.items()}
    return sorted((i, out[i], group[i], group[i] == i) for i in ids)


@pytest.mark.parametrize("cell", [40, 2048])
def test_equals_brute_force(spark, cell):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist(), int(rng.choice([1, 1, 1, 2]))) for i, v in enumerate(points(rng, 260, 8))]
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 8, 1), (1003, [None] + [1.0] * 7, 1), (1004, [float("nan")] * 8, 1),
             (1005, [float("inf")] * 8, 1), (1006, rows[0][1], None), (1007, rows[0][1], rows[0][2]), (1007, rows[0][1], rows[0][2]),
             (1008, [1e200] * 8, 2), (1009, [1e-200] * 8, 2), (1010, [1.0, 0.5], 1), (1011, [1.0, 0.5], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, task string")
    got = covertree.near_duplicates(table, cell=cell).collect()
    assert sorted(tuple(r) for r in got) == slow([r if r[0] < 1008 or r[0] > 1009 else (r[0], [1.0] * 8, 2) for r in rows])


def test_empty_table(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0

from __future__ import annotations

import numpy as np
import pytest

from larder.llm import search


def brute(rows, queries, k):
    found = []
    for q, x in queries:
        scored = sorted((-float(np.dot(x, y)), i) for i, y in rows if i != q)
        found += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, vector array<double>, shard int, kind string").drop("shard")


@pytest.mark.parametrize("shard", [7, 64, 1000])
def test_equals_all_pairs(spark, shard):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(300)]
    rows += [(300 + i, [1.0, 2.0, 3.0, 0.0, 0.0]) for i in range(90)]  # ties
    asked = rows[::20]
    df = vectors(spark, [(i, x, 1, "k") for i, x in rows])
    got = search.top_k(df, df.where("vec_id % 20 = 0"), 5, shard=shard)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, asked, 5)


def test_bounds_prune(monkeypatch):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.01, (200, 3)) for c in (0, 5, 10, 20)])
    tree = search.BallTree(points)
    seen = []
    real = search._bound
    monkeypatch.setattr(search, "_bound", lambda q, n, node: seen.append(len(node[2])) or real(q, n, node))
    scores, found = search.tree_search(tree, np.arange(800), np.ones((1, 3)), np.array([-1]), np.array([-np.inf]), 3)
    assert len(seen) < 20
    best = np.argsort(-points.sum(axis=1))[:3]
    assert found[0].tolist() == best.tolist()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [2.0]), (None, [9.0, 9.0]), (7, [1.0, 0.0]), (7, [3.0, 0.0])]
    df = vectors(spark, [(i, x, 1, "k") for i, x in rows])
    got = search.top_k(df, df, 2).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 7, 3.0), (0, 2, 7, 1.0), (7, 1, 0, 1.0)]
    assert search.top_k(df.limit(0), df, 2).count() == search.top_k(df, df.limit(0), 2).count() == 0


def clusters(rng, n, dims=8):
    middles = rng.normal(0, 10, (12, dims))
    return [(i, (middles[i % 12] + rng.normal(0, 0.2, dims)).round(2).tolist()) for i in range(n)]


def test_queries_go_to_few_cells(spark, monkeypatch):
    rows = clusters(np.random.default_rng(3), 1500)
    df = vectors(spark, [(i, x, 1, "k") for i, x in rows])
    asked = df.where("vec_id % 50 = 0")
    counted, cells = [], []
    real = search.sent

    def counting(queries, own, first, last):
        to = real(queries, own, first, last)
        counted.append(to.count())
        cells.append(sum(map(len, own.centres.values())))
        return to

    monkeypatch.setattr(search, "sent", counting)
    got = sorted(tuple(r) for r in search.top_k(df, asked, 3, shard=240).collect())
    assert [g[:3] for g in got] == [g[:3] for g in brute(rows, rows[::50], 3)]
    assert len(counted) == 3 and cells[0] >= 40
    assert sum(counted) < 30 * cells[0] / 3


def test_cells_of_equal_vectors_are_dealt_into_shards(spark):
    rows = [(i, [1.0, 2.0]) for i in range(100)] + [(100 + i, [float(i), 0.0]) for i in range(20)]
    df = vectors(spark, [(i, x, 1, "k") for i, x in rows])
    got = search.top_k(df, df.where("vec_id % 30 = 0"), 4, shard=8)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, rows[::30], 4)


def test_bounds_hold_for_every_vector():
    rng = np.random.default_rng(6)
    points = rng.normal(0, 3, (400, 6))
    cells = search.Cells({6: search._centres(points[:100], 20)})
    cell, far = cells.nearest(points.tolist())
    np.maximum.at(cells.reach[6], cell, far)
    for query in rng.normal(0, 2, (20, 6)):
        scores = points @ query
        floor = np.sort(scores)[-3]
        assert set(cell[scores >= floor]) <= set(cells.reached(query.tolist(), floor, 0, None))

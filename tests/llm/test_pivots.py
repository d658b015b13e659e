"""Pivot-table search against loops over all pairs."""

import math

import numpy as np
import pytest

from wildgrid.llm import pivots


def usable(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, asked, k: int) -> dict:
    own: dict = {}
    for i, v, *_ in rows:
        if i is not None and usable(v):
            w = [math.floor(256 * x) for x in v]
            own[i] = min(w, own.get(i, w))
    size = max(map(len, own.values()), default=0)
    own = {i: w + [0] * (size - len(w)) for i, w in own.items()}
    out = {}
    for q in own:
        if asked(q):
            best = sorted((-sum(a * b for a, b in zip(own[q], own[c])), c) for c in own if c != q)[:k]
            out |= {(q, rank + 1): (c, -s) for rank, (s, c) in enumerate(best)}
    return out


def found(spark, df, k: int, **options) -> dict:
    rows = pivots.whole_numbers(df)
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in pivots.top_k(rows, rows.where("vec_id % 5 = 0"), k, **options).collect()}


@pytest.mark.parametrize("seed,dimension,clusters,sizes", [(1, 3, 4, (16, 7)), (2, 8, 40, (50, 20)), (3, 1, 2, (9, 30)), (4, 12, 1, (1000, 1000))])
def test_search_is_that_of_loops(spark, monkeypatch, seed, dimension, clusters, sizes):
    """Near vectors, ties (values on a coarse grid), copies under other ids and many small blocks and lanes."""
    monkeypatch.setattr(pivots, "LANE", 3)
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, (clusters, dimension))
    rows = [(int(k), [float(x) for x in np.round(centres[rng.integers(clusters)] + rng.normal(0, 0.2, dimension), 1)]) for k in rng.permutation(400)]
    rows += [(k, rows[0][1]) for k in range(400, 460)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    assert found(spark, df, 5, pivots=12, row_block=sizes[0], query_block=sizes[1]) == brute(rows, lambda q: q % 5 == 0, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, [0.0, 0.0]), (10, None), (15, [nan, 1.0]), (20, [inf, 0.0]), (25, [None, 1.0]), (None, [1.0, 1.0]), (1, []), (2, [-0.001]), (30, [0.5, -0.25, 4.0]), (30, [0.5, -0.25, 3.0]), (30, [0.5, -0.25, 3.0]), (35, [700_000.3, 1e6]), (36, [-700_000.3, 0.1])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, cell string")
    for k in (1, 5, 50):
        assert found(spark, df, k) == brute(rows, lambda q: q % 5 == 0, k)
    assert found(spark, df.where("vec_id = 0"), 5) == {} and found(spark, df.limit(0), 5) == {} and found(spark, df.where("vec_id = 1 or vec_id = 2"), 5) == {}
    huge = spark.createDataFrame([(0, [1e300]), (5, [1.0]), (6, [2.0])], "vec_id long, embedding array<double>")
    assert found(spark, huge, 5) == {(5, 1): (6, 131072)}


def test_bounds_hold_and_leave_rows_out():
    """No score is above its bound; near vectors are found without computing most scores."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-3000, 3000, (30, 16))
    v = (centres[rng.integers(30, size=2000)] + rng.integers(-60, 60, (2000, 16))).astype(np.int64)
    p = v[:40].astype(np.float64)
    dist, norm = pivots._distances(v.astype(np.float64), p), (v.astype(np.float64) ** 2).sum(1)
    q = slice(0, 20)
    exact = v[q] @ v.T
    assert (pivots.row_bounds(dist[q], norm[q], dist, norm) >= exact).all()
    assert pivots.block_bounds(dist[q], norm[q], dist.min(0)[None], dist.max(0)[None], np.array([norm.max()]))[:, 0].tolist() >= exact.max(1).tolist()
    ids, done = np.arange(2000), 0
    for k in range(20):
        best = pivots.Best(ids[k : k + 1], 5)
        done += pivots.evaluate(best, v[k : k + 1], dist[k : k + 1], norm[k : k + 1], ids, v, dist, norm, step=50)
        assert best.ids[0].tolist() == [c for _, c in sorted((-exact[k, c], c) for c in range(2000) if c != k)[:5]]
    assert done < 20 * 2000 / 4


def test_scores_beyond_floating_point_are_exact():
    a = np.array([[2**28 - 1, 2**28 - 3]])
    norm = (a.astype(float) ** 2).sum(1)
    assert pivots.scores(a, norm, a, norm)[0, 0] == (2**28 - 1) ** 2 + (2**28 - 3) ** 2

"""The Voronoi join against all pairs."""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from missive.llm import knn
from missive.llm.queries import op11_topk

DDL = "vec_id bigint, embedding array<float>"


def brute(rows, asked, k=5, scale=256):
    """(query_id, rank, vec_id, score), in exact numbers."""
    fit = set()
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.add((i, tuple(math.floor(scale * Fraction(float(np.float32(x)))) for x in v)))
    out = []
    for q in sorted(x for x in fit if asked(x[0])):
        scores = sorted((-sum(a * b for a, b in zip(q[1], o[1])), o[0]) for o in fit if o != q)
        out += [(q[0], rank, i, -score) for rank, (score, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def plain(found):
    return sorted(tuple(r) for r in found.collect())


def clustered(n, dims=4, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, dims)) * 3
    return [(i, (centres[i % 8] + draw.normal(size=dims) * 0.1).tolist()) for i in range(n)]


def test_query_against_all_pairs(spark, small):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = op11_topk(spark, small)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert plain(found) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("limits", [{"queries": 7, "rows": 40}, {"queries": 1_000, "pivots": 3, "rows": 9}])
def test_clusters_blocks_and_slices(spark, limits):
    rows = clustered(400)
    found = knn.search(spark.createDataFrame(rows, DDL), F.col("id") % 5 == 0, **limits)
    assert plain(found) == brute(rows, lambda i: i % 5 == 0)


def test_bounds_exclude_and_lose_nothing():
    x = np.floor(256 * np.array([v for _, v in clustered(800)]))
    cells = knn.Pivots(x[::37])
    at, r, norms = cells.nearest(x)
    k = 5
    queries = [(c, r[at == c].max(), norms[at == c].max(), int((at == c).sum())) for c in np.unique(at)]
    nearest = [(c, y) for c in np.unique(at) for y in np.sort(r[at == c])[: k + 1]]
    plan = knn.Plan(cells, queries, nearest, k, 100)
    kept = 0
    for g, own in enumerate(plan.groups):
        need = plan.needed(g, at, r)
        kept += need.sum()
        for i in np.flatnonzero(np.isin(at, own)):
            scores = x @ x[i]
            scores[i] = -np.inf
            assert need[scores >= np.sort(scores)[-k]].all()
    assert len(plan.groups) > 4 and kept < 0.6 * len(x) * len(plan.groups)
    assert sorted(c for own in plan.groups for c in own) == sorted(np.unique(at))


def test_copies_ties_nulls_and_clashing_columns(spark):
    rows = [(i, [0.5, 0.25]) for i in range(0, 200)] + [(i, [0.0, 0.0]) for i in range(200, 260)]
    rows += rows[:30] + [(7, [1.0, -1.0]), (None, [1.0, 1.0]), (50, None), (100, [1.0, None]), (150, [float("nan"), 1.0])]
    rows += [(151, [float("inf"), 1.0]), (300, []), (350, [2.0]), (400, [-0.001, 3.0, 1.0]), (-50, [0.1, 0.1])]
    table = spark.createDataFrame(rows, DDL)
    table = table.withColumns({c: F.lit("x") for c in ("id", "v", "q", "cell", "r", "norm", "grp", "slice", "block", "score")})
    expected = brute(rows, lambda i: i % 50 == 0)
    for limits in ({}, {"queries": 2, "rows": 3, "pivots": 4}):
        assert plain(knn.search(table, F.col("id") % 50 == 0, **limits)) == expected


def test_few_rows_and_none(spark):
    one = spark.createDataFrame([(0, [1.0]), (50, [2.0])], DDL)
    assert plain(knn.search(one, F.col("id") % 50 == 0)) == [(0, 1, 50, 131_072), (50, 1, 0, 131_072)]
    assert plain(knn.search(one.limit(1), F.col("id") % 50 == 0)) == []
    assert knn.search(one.limit(0), F.col("id") % 50 == 0).count() == 0
    assert knn.search(one, F.col("id") == 3).count() == 0


def test_large_components(spark):
    rows = [(i, [float(2**20 + i), float(-i * 3)]) for i in range(0, 120, 2)]
    assert plain(knn.search(spark.createDataFrame(rows, DDL), F.col("id") % 50 == 0)) == brute(rows, lambda i: i % 50 == 0)
    with pytest.raises(ValueError):
        knn.search(spark.createDataFrame([(1, [1e12])], DDL), F.col("id") == 1)


def test_vectors_of_unequal_length():
    found = knn.matrix(pa.array([[1, 2], [], [3]], pa.list_(pa.int16())), 2)
    assert found.tolist() == [[1, 2], [0, 0], [3, 0]]

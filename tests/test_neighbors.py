import numpy as np
import pytest

from missive.operators.neighbors import _groups, knn_join, nearest


def vectors(spark, x, start=0):
    rows = [(start + i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, embedding array<float>")


def brute(q, x, k, metric):
    q, x = q.astype(np.float32).astype(float), x.astype(np.float32).astype(float)
    if metric == "l2":
        d = ((q[:, None, :] - x[None, :, :]) ** 2).sum(2)
    else:
        norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :]
        d = 1 - np.divide(q @ x.T, norms, out=np.zeros(norms.shape), where=norms > 0)
    order = [sorted(range(len(x)), key=lambda j: (round(row[j], 9), j))[:k] for row in d]
    return {i: [(j, d[i, j]) for j in ids] for i, ids in enumerate(order)}


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("block_rows", [4096, 40])
def test_equals_brute_force(spark, metric, block_rows):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 8)) * 4
    x = np.vstack([centres[rng.integers(0, 6, 250)] + rng.normal(size=(250, 8)), np.repeat(centres[:1], 150, axis=0)])
    x[3] = 0
    q = np.vstack([x[:60], rng.normal(size=(30, 8)), np.zeros((1, 8))])
    got = knn_join(vectors(spark, q), vectors(spark, x), 5, metric, query_id="id", block_rows=block_rows)
    expected = brute(q, x, 5, metric)
    rows = {}
    for r in got.collect():
        rows.setdefault(r.query_id, {})[r["rank"]] = (r.id, r.distance)
    assert set(rows) == set(expected)
    for i, wanted in expected.items():
        found = [rows[i][r] for r in range(1, 6)]
        assert [d for _, d in found] == pytest.approx([d for _, d in wanted], abs=1e-6)
        assert [j for j, _ in found] == [j for j, _ in wanted]


def test_crowded_cell_is_cut_into_blocks(spark):
    x = np.zeros((500, 4))
    got = knn_join(vectors(spark, x[:90]), vectors(spark, x), 3, query_id="id", block_rows=50)
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert {tuple(sorted((r.id, r.distance) for r in got.where(f"query_id = {i}").collect())) for i in (0, 89)} == {
        ((0, 0.0), (1, 0.0), (2, 0.0))
    }


def test_fewer_rows_than_k(spark):
    x = np.eye(3)
    for block_rows in (100, 1):
        assert knn_join(vectors(spark, x), vectors(spark, x), 5, query_id="id", block_rows=block_rows).count() == 9
    empty = vectors(spark, x).limit(0)
    assert knn_join(vectors(spark, x), empty, 5, query_id="id").count() == 0


def test_self_is_nearest_and_single_query_agrees(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    joined = knn_join(table, table, 1, query_id="id")
    assert joined.where("query_id = id and distance = 0").count() == table.count()
    first = table.where("id = 7").first().embedding
    one = [r.id for r in nearest(table, first, 5).collect()]
    many = [r.id for r in knn_join(table.where("id = 7"), table, 5, query_id="id").orderBy("rank").collect()]
    assert one == many and one[0] == 7
    with pytest.raises(ValueError, match="metric"):
        nearest(table, first, metric="l1")


def test_far_from_the_origin_is_as_exact(spark):
    rng = np.random.default_rng(12)
    x = 1e6 + 0.05 * rng.normal(size=(300, 8))
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id bigint, embedding array<double>")
    got = knn_join(frame, frame, 5, query_id="id").collect()
    true = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    for r in got:
        assert r.id == np.lexsort((np.arange(300), true[r.query_id]))[r["rank"] - 1]
    assert len(got) == 1500


def test_queries_are_copied_once_for_each_block(spark):
    """Without clusters every cell may hold a nearest row; cells that share a block get one copy of a query."""
    frame = vectors(spark, np.random.default_rng(3).normal(size=(2000, 32)))
    found = knn_join(frame, frame, 5, query_id="id", block_rows=1000)
    assert found.count() == 10_000
    assert _groups([45] * 44, 1000).max() == 1 and list(_groups([5, 1, 1, 9, 1], 4)) == [0, 1, 1, 2, 3]
